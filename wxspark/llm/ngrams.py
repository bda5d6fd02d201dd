"""Hashed n-gram counts of texts, in numpy."""

from __future__ import annotations

import numpy as np

#: Texts counted together, and bytes taken at once, to bound memory.
TEXTS, BYTES = 128, 1 << 20


def hashed_counts(texts: list[bytes], dims: int, sizes: tuple[int, ...]) -> np.ndarray:
    """How often each of ``dims`` hash values (a power of two) has an n-gram of bytes, for
    each text: float32, (texts, dims)."""
    out = np.zeros((len(texts), dims), np.float32)
    shift = np.uint32(32 - dims.bit_length() + 1)

    def add(first: int, group: list[bytes]) -> None:
        lengths = np.array([len(x) for x in group])
        data = np.frombuffer(b"".join(group), np.uint8).astype(np.uint32)
        owner = np.repeat(np.arange(len(group)), lengths)
        gram = np.zeros(len(data), np.uint32)
        for n in range(1, max(sizes) + 1):
            if len(data) < n:
                break
            gram = (gram[: len(data) - n + 1] * np.uint32(0x01000193)) ^ (data[n - 1 :] + np.uint32(1))
            if n in sizes:
                own = owner[: len(gram)]
                same = own == owner[n - 1 :]
                slot = (gram * np.uint32(2654435761) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) >> shift
                bins = np.bincount((own * dims + slot)[same], minlength=len(group) * dims)
                out[first : first + len(group)] += bins.reshape(len(group), dims)

    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and end - at < TEXTS and (end == at or size + len(texts[end]) <= BYTES):
            size += len(texts[end])
            end += 1
        if end == at + 1 and size > BYTES:  # a long text goes in pieces, each n-gram in one of them
            text, step = texts[at], BYTES - max(sizes)
            for n in sizes:
                for s in range(0, len(text), step):
                    out[at] += hashed_counts([text[s : s + step + n - 1]], dims, (n,))[0]
        else:
            add(at, texts[at:end])
        at = end
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows over their length; zero stays zero."""
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
