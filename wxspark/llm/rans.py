"""Token ids as a file of entropy-coded blocks (static range asymmetric numeral system).

A file is two Parquet tables: ``tables`` (id, freq), the frequencies that all blocks share,
summing to 2**PRECISION, and ``blocks``, in ascending order of doc_id. A block holds whole
documents, at least ``BLOCK`` ids unless it is the last of its part, and decodes alone:

    part, block   its place: parts are ranges of doc_id
    at            checkpoint: ids of its part before it
    n_ids         ids in it
    doc_ids       its documents' ids, with null among them
    lengths       ids of each document
    states        final coder state of each lane (uint64)
    words         the coded words (uint32) of all lanes, interleaved
    crc           CRC-32 of its ids as little-endian uint32

Id i of a block belongs to lane i mod LANES; one step codes an id of every lane.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import read, written
from wxspark.llm.tokens import id_type, tokenized

PRECISION, LANES, BLOCK = 20, 1024, 1 << 17
#: Ids of a part, about, and parts at most: beyond that they grow, and their blocks, each a
#: checkpoint, stay as they are.
PART, PARTS = 1 << 22, 1 << 14
LOW = np.uint64(1 << 31)


def frequencies(counts: dict[int, int]) -> dict[int, int]:
    """Counts of ids scaled to sum to 2**PRECISION, at least 1 each."""
    total, whole = sum(counts.values()), 1 << PRECISION
    if len(counts) > whole:
        raise ValueError(f"{len(counts)} ids don't fit a table of {whole} slots")
    f = {k: max(1, n * whole // total) for k, n in sorted(counts.items())}
    over = sum(f.values()) - whole
    for k in sorted(f, key=lambda k: (-f[k], k)):
        if over <= 0:
            break
        less = min(over, f[k] - max(1, f[k] // 2))
        f[k] -= less
        over -= less
    if f and over < 0:
        f[max(f, key=lambda k: (f[k], -k))] -= over
    return f


class Coder:
    """The arrays of a shared table: frequency and first slot by id, id by slot."""

    def __init__(self, freqs: dict[int, int]):
        ids = np.array(sorted(freqs), np.int64)
        f = np.array([freqs[i] for i in ids.tolist()], np.uint64)
        top = int(ids[-1]) + 1 if len(ids) else 0
        self.freq, self.first = np.zeros(top, np.uint64), np.zeros(top, np.uint64)
        self.freq[ids] = f
        self.first[ids] = np.cumsum(f) - f
        self.slot_id = np.repeat(ids, f.astype(np.int64)).astype(np.uint32)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids to (states, words)."""
        states = np.full(min(LANES, len(ids)), LOW, np.uint64)
        chunks, shift, room = [], np.uint64(PRECISION), np.uint64(63 - PRECISION)
        half, mask = np.uint64(32), np.uint64(0xFFFFFFFF)
        freq, first = self.freq[ids], self.first[ids]
        for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES) if len(ids) else ():
            f, c = freq[at : at + LANES], first[at : at + LANES]
            x = states[: len(f)]
            full = x >= f << room
            chunks.append((x[full] & mask).astype("<u4"))
            x = np.where(full, x >> half, x)
            q = x // f
            states[: len(f)] = (q << shift) + (x - q * f) + c
        return states, np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")

    def decode(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        out, x, at = np.empty(n, np.uint32), states.astype(np.uint64), 0
        shift, half, mask = np.uint64(PRECISION), np.uint64(32), np.uint64((1 << PRECISION) - 1)
        words = words.astype(np.uint64)
        for i in range(0, n, LANES):
            y = x[: min(LANES, n - i)]
            slot = y & mask
            ids = self.slot_id[slot]
            out[i : i + LANES] = ids
            y = self.freq[ids] * (y >> shift) + slot - self.first[ids]
            empty = np.flatnonzero(y < LOW)
            y[empty] = (y[empty] << half) | words[at : at + len(empty)]
            at += len(empty)
            x[: len(y)] = y
        return out


BLOCKS = "part int, block int, at bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, states binary, words binary, crc bigint"


def write_ids(tokens: DataFrame, kind: str = "<u4") -> tuple[DataFrame, DataFrame]:
    """(doc_id, ids), ids of type ``kind``, to the written tables ``blocks`` and ``tables``.

    Documents are in ascending order of doc_id, null first; repeated ids by the CRC of
    their ids. An empty table gives two empty ones.
    """
    spark = tokens.sparkSession

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            n = np.bincount(np.frombuffer(b"".join(x for x in b.column(0).to_pylist() if x), kind))
            if len(n) > len(total):
                n, total = total, n.copy()
            total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    # A count for each id: as many rows as the vocabulary has, at most.
    counts = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    freqs = frequencies({r["id"]: r["n"] for r in counts})
    parts = min(PARTS, max(1, -(-sum(r["n"] for r in counts) // PART)))

    def encode(batches):
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), Coder(freqs)
        block, at, docs, held = 0, 0, [], []

        def done():
            ids, width = np.frombuffer(b"".join(held), kind), np.dtype(kind).itemsize
            raw = ids.astype("<u4")
            states, words = coder.encode(raw)
            row = [part, block, at, len(raw), docs, [len(x) // width for x in held], states.astype("<u8").tobytes(), words.tobytes(), zlib.crc32(raw)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in BLOCKS.split(", ")])

        size, width = 0, np.dtype(kind).itemsize
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                docs.append(doc)
                held.append(ids.as_py() or b"")
                size += len(held[-1]) // width
                if size >= BLOCK:
                    yield done()
                    block, at, size, docs, held = block + 1, at + size, 0, [], []
        if docs:
            yield done()

    keyed = tokens.withColumn("tie", F.crc32("ids"))
    ordered = keyed.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    blocks = written(ordered.mapInArrow(encode, BLOCKS), "rans-blocks", compression="none")
    rows = spark.createDataFrame(sorted(freqs.items()), "id bigint, freq bigint")
    return blocks, written(rows.coalesce(1), "rans-tables")


def read_ids(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """The tables of a file to (doc_id, start, n_ids, ids), one row per document; start
    counts the ids of all documents before it. A block whose CRC is wrong is an error."""
    freqs = {r["id"]: r["freq"] for r in tables.collect()}  # no longer than the vocabulary
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that its size is known: blocks are not shuffled to meet a few rows.
    parts = written(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_at")), "rans-parts")

    def decode(batches):
        coder = Coder(freqs)
        for b in batches:
            for r in b.to_pylist():
                try:
                    ids = coder.decode(np.frombuffer(r["states"], "<u8"), np.frombuffer(r["words"], "<u4"), r["n_ids"])
                    raw = ids.astype("<u4").tobytes()
                except (IndexError, ValueError):  # it ran out of words
                    raw = None
                if raw is None or zlib.crc32(raw) != r["crc"]:
                    raise ValueError(f"block {r['block']} of part {r['part']} is damaged")
                n = np.array(r["lengths"], np.int64)
                at = np.concatenate(([0], np.cumsum(n)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["doc_ids"], pa.int64()),
                        pa.array(r["part_at"] + r["at"] + at[:-1], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([raw[4 * s : 4 * e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_ids", "ids"],
                )

    return blocks.join(parts, "part").mapInArrow(decode, "doc_id bigint, start bigint, n_ids bigint, ids binary")


def op6_rans(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    kind = id_type(path, end_id=2)
    tokens = written(tokenized(docs, path, end_id=2, kind=kind), "ids", compression="zstd")
    back = read_ids(*write_ids(tokens, kind))
    return back.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
