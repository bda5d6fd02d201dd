"""Token ids of texts, by the tokenizers library, inside Spark's Python workers."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Words whose ids a worker keeps, at most, and the longest kept; beyond the first it starts
#: anew. Bytes of text that are looked up together, if there is more than one text.
KEPT_WORDS, KEPT_LENGTH, BYTES = 1_000_000, 64, 1 << 23
#: Texts where a word's ids may depend on its neighbours; words of pre-tokens that are known
#: apart: letters, a sign, and the same after a line feed.
SIGNS, LETTERS = ".,;:!?", "[A-Za-zÀ-ÖØ-öø-ÿ]+"
ODD, PLAIN = re.compile(r"\s \s"), re.compile(f"({LETTERS})([{SIGNS}]?)(?:(\n)({LETTERS})([{SIGNS}]?))?")


def id_type(tokenizer: str, end_id: int = 0) -> str:
    """Narrowest little-endian type that holds all ids: two bytes, or four."""
    import tokenizers

    top = max(tokenizers.Tokenizer.from_file(tokenizer).get_vocab().values(), default=0)
    return "<u2" if max(top, end_id) < 1 << 16 else "<u4"


def byte_letters() -> dict[int, int]:
    """Byte to the letter that stands for it in a byte-level vocabulary: printable bytes for
    themselves, the others for the letters from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 0x100 + i for i, b in enumerate(others)}


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of stretches, each from its start on, one after another."""
    upto = np.cumsum(sizes)
    n = int(upto[-1])
    # Half the memory to move where the places are small.
    kind = np.int32 if max(n, int((starts + sizes).max())) < 1 << 31 else np.int64
    out = np.repeat((starts - upto + sizes).astype(kind), sizes)
    out += np.arange(n, dtype=kind)
    return out


class Encoder:
    """Texts to ids, as ``encode`` gives them for a byte-level BPE whose pre-tokens begin at
    a space, where there is one.

    Ids of a word with its space before it don't depend on the words around it, so a worker
    encodes each word that it meets once, and keeps it, save very long ones. Texts in which
    a space stands between two white-space characters, where that may not hold, are encoded
    whole. New words of letters alone are one pre-token each, so the library's model takes
    many at once, and a word's first id, alone, begins with a space. A sign after them, a line
    feed, and letters after it are pre-tokens too: such words are put together from these.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.bare = tokenizers.Tokenizer(self.model.model)
        vocabulary, self.letters = self.model.get_vocab(), byte_letters()
        self.space = chr(self.letters[0x20])
        self.spaced = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(self.space)]] = True
        self.feed = chr(self.letters[0x0A])
        self.feed_id = vocabulary.get(self.feed, -1)
        self.signs = self.each(list(SIGNS))
        self.clear()

    def clear(self) -> None:
        """Nothing kept but the signs. Keys of parts of words are pairs: (before, part)."""
        self.words: dict = {}
        self.ids, self.ends = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)
        self.add([("", x) for x in SIGNS], np.concatenate(self.signs), np.array([len(x) for x in self.signs]))

    def each(self, texts: list[str]) -> list[np.ndarray]:
        # The fast variant leaves out the offsets of tokens, which nobody reads here.
        return [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.words), int(self.ends[len(self.words) - 1]) if self.words else 0
        self.words.update(zip(words, range(n, n + len(words)), strict=True))
        while m + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        while len(self.words) > len(self.ends):
            self.ends = np.append(self.ends, np.zeros_like(self.ends))
        self.ids[m : m + len(ids)] = ids
        self.ends[n : len(self.words)] = m + np.cumsum(sizes)

    def letters_of(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)

    def parts(self, keys: list, coded: list[str], first) -> None:
        """Adds pre-tokens that the bare model takes together; ``first`` finds their first ids.
        A vocabulary in which it does not is no such one: the keys stay unknown."""
        ids = np.array(self.bare.encode_batch_fast([coded], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(first(ids))
        if len(at) == len(keys):
            self.add(keys, ids, np.diff(np.append(at, len(ids))))

    def keep(self, words: list[str]) -> None:
        """Encodes words, each with a space before it, and keeps them."""
        bodies, lines, joined, keys, many, rest = {}, {}, [], [], [], []
        for w in words:
            if w.isascii() and w.isalpha():
                bodies[w] = None
                continue
            m = PLAIN.fullmatch(w)
            if m is None:
                rest.append(w)
                continue
            body, sign, feed, line, end = m.groups()
            bodies[body] = None
            if sign or feed:
                at = len(keys)
                keys.append(body)
                if sign:
                    keys.append(("", sign))
                if feed:
                    lines[line] = None
                    keys.append(("\n", line))
                    if end:
                        keys.append(("", end))
                joined.append(w)
                many.append(len(keys) - at)
        get = self.words.get
        new = [w for w in bodies if w not in self.words]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            self.parts(some, [self.space + (w if w.isascii() else self.letters_of(w)) for w in some], lambda ids: self.spaced[ids])
        new = [w for w in lines if ("\n", w) not in self.words]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            coded = [x for w in some for x in (self.feed, self.letters_of(w))]
            self.parts([("\n", w) for w in some], coded, lambda ids: ids == self.feed_id)
        rest += [w for w in bodies if w not in self.words]
        if joined:
            many = np.array(many)
            own = np.array([get(k, -1) for k in keys])
            whole = np.minimum.reduceat(own, np.cumsum(many) - many) >= 0
            rest += [w for w, known in zip(joined, whole.tolist(), strict=True) if not known]
            own, many = own[np.repeat(whole, many)], many[whole]
            joined = [w for w, known in zip(joined, whole.tolist(), strict=True) if known]
        if joined:
            starts = np.where(own > 0, self.ends[own - 1], 0)
            sizes = self.ends[own] - starts
            ids = self.ids[places(starts, sizes)]
            self.add(joined, ids, np.add.reduceat(sizes, np.cumsum(many) - many))
        for at in range(0, len(rest), 4096):
            some = self.each([" " + w for w in rest[at : at + 4096]])
            self.add(rest[at : at + 4096], np.concatenate(some), np.array([len(x) for x in some]))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """A text array (null: empty) to the ids of all texts, each with ``end_id`` after it,
        and how many each text has."""
        if len(self.words) > KEPT_WORDS:
            self.clear()
        plain = [t or "" for t in texts.to_numpy(zero_copy_only=False).tolist()]
        whole = [ODD.search(t) is not None for t in plain]
        split = pc.split_pattern(pa.array(["" if w else t for w, t in zip(whole, plain, strict=True)], pa.large_string()), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        known, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        heads = self.each([t if w else known[index[b]] for w, t, b in zip(whole, plain, bounds, strict=False)])
        inner = np.ones(len(index), bool)
        inner[bounds[:-1]] = False
        used = np.zeros(len(known), bool)
        used[index[inner]] = True
        place = np.full(len(known), -1, np.int64)
        get, asked = self.words.get, np.flatnonzero(used).tolist()
        found = [get(known[i], -1) for i in asked]
        new = [known[i] for i, f in zip(asked, found, strict=True) if f < 0]
        if new:
            self.keep([w for w in new if len(w) <= KEPT_LENGTH])
            found = [f if f >= 0 else get(known[i], -1) for i, f in zip(asked, found, strict=True)]
        place[asked] = found
        far = [i for i, f in zip(asked, found, strict=True) if f < 0]
        # All segments (heads, words, ends) in order, as places in one array of ids.
        extra = heads + self.each([" " + known[i] for i in far]) + [np.array([end_id], np.uint32)]
        base = int(self.ends[len(self.words) - 1]) if self.words else 0
        flat = np.concatenate([self.ids[:base], *extra])
        size = np.array([len(x) for x in extra], np.int64)
        start = base + np.cumsum(size) - size
        n, ends = len(plain), self.ends[: len(self.words)]
        sizes = np.concatenate([np.diff(ends, prepend=0), size])
        starts = np.concatenate([ends - np.diff(ends, prepend=0), start])
        place[far] = len(ends) + n + np.arange(len(far))
        segment = np.empty(len(index) + n, np.int64)
        last = bounds[1:] + np.arange(n)
        body = np.ones(len(segment), bool)
        body[last] = False
        segment[body] = place[index]
        segment[bounds[:-1] + np.arange(n)] = len(ends) + np.arange(n)
        segment[last] = len(sizes) - 1
        many = sizes[segment]
        return flat[places(starts[segment], many)], np.diff(np.cumsum(many)[last], prepend=0)


def encoder(path: str) -> Encoder:
    """This worker's encoder: kept on the library, so that the words stay for its next tasks."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_wxspark_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def slices(batch: pa.RecordBatch):
    """Parts of a batch (doc_id, text) of some BYTES of text each, and at least a row."""
    text = batch.column(1)
    upto = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def binary_rows(ids: np.ndarray, sizes: np.ndarray, kind: str) -> pa.Array:
    """Ids one after another to a binary array, ``sizes`` ids a row."""
    raw = ids.astype(kind)
    offsets = np.concatenate(([0], np.cumsum(sizes) * raw.itemsize)).astype("<i8")
    rows = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])
    return rows.cast(pa.binary())


def widened(ids: bytes | None, kind: str) -> bytes:
    """Ids of type ``kind`` as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids or b"", kind).astype("<u4").tobytes()


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, kind: str = "<u4") -> DataFrame:
    """(doc_id, text, ...) to (doc_id, ids): ids of the whole text (null: empty) and then
    ``end_id``, of type ``kind``. ``tokenizer`` is a file that executors can read."""

    def run(batches):
        model = encoder(tokenizer)
        for b in batches:
            for part in slices(b):
                rows = binary_rows(*model.encode(part.column(1), end_id), kind)
                yield pa.RecordBatch.from_arrays([part.column(0), rows], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary")
