"""Packing of token sequences by large-item matching and best fit.

Lengths are integers up to the capacity, so the packing is found on their counts, whatever
the number of documents: pieces over a third of the capacity, of which a sequence holds two
at most, are matched greedily (the longest with the longest that still fits); shorter ones,
longest first, go where they leave the least room. The plan is a list of ranges (of the
n-th to the m-th piece of a length, to sequence and offset), and each piece looks itself up
by its length and its rank in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import buckets_for, read, running_total, written
from wxspark.llm.tokens import binary_rows, encoder, id_type, slices, widened

CAPACITY = 2048


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Counts of lengths to (length, rank, pieces in each sequence, first sequence, offset
    of the first, pieces in all), sorted. As many ranges as lengths and gaps, times a few."""
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must be 1 to {capacity}")
    bins: list[list] = []  # [how many, gap, [(length, pieces)]]
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(many: int, content: list[tuple[int, int]]) -> None:
        gap = capacity - sum(n * k for n, k in content)
        by_gap[gap].append(len(bins))
        bins.append([many, gap, content])

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        for b in (b for b in large if b <= a):
            if not left[a]:
                break
            if a + b > capacity or not left[b]:
                continue
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
            if pairs:
                add(pairs, [(a, 1), (b, 1)] if a != b else [(a, 2)])
                left[a] -= pairs
                left[b] -= pairs
        if left[a]:
            add(left[a], [(a, 1)])
            left[a] = 0
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        for gap in range(n, capacity + 1):
            while todo and by_gap[gap]:
                i = by_gap[gap].pop()
                many, _, content = bins[i]
                fit = gap // n
                full = min(many, todo // fit)
                if full:
                    add(full, [*content, (n, fit)])
                    todo -= full * fit
                rest = many - full
                if rest and todo:  # fewer than fit are left
                    add(1, [*content, (n, todo)])
                    todo, rest = 0, rest - 1
                bins[i][0] = rest
                if rest:
                    by_gap[gap].append(i)
            if not todo:
                break
        fit = capacity // n
        if todo // fit:
            add(todo // fit, [(n, fit)])
        if todo % fit:
            add(1, [(n, todo % fit)])
    plan, rank, sequence = [], dict.fromkeys(counts, 0), 0
    for many, _, content in bins:
        offset = 0
        for n, k in content if many else ():
            plan.append((n, rank[n], k, sequence, offset, many * k))
            rank[n] += many * k
            offset += n * k
        sequence += many
    return sorted(plan)


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, kind: str = "<u4") -> DataFrame:
    """(doc_id, text, ...) to (doc_id, piece, start, length, ids): the ids of the whole text
    (null: empty) and ``end_id``, cut only where longer than ``capacity``, the first piece
    taking the remainder; ids of type ``kind``."""

    def run(batches):
        model = encoder(tokenizer)
        for b in batches:
            for part in slices(b):
                ids, sizes = model.encode(part.column(1), end_id)
                pieces = -(-sizes // capacity)
                of = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (sizes - 1) % capacity + 1
                length = np.where(piece == 0, first[of], capacity)
                start = np.where(piece == 0, 0, first[of] + (piece - 1) * capacity)
                columns = [part.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), binary_rows(ids, length, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    ``pieces`` is read three times: hand in a written table. Every row is a piece of its
    own, repeated ones too; null ids are values like others. Nothing is left out.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = packing_plan(counts, capacity)
    key = F.md5(F.concat_ws(":", F.lit("pack"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("piece").cast("string")))
    keyed = pieces.withColumn("__wx_o", key).withColumn("__wx_1", F.lit(1).cast("bigint"))
    ranked = running_total(keyed, ["length"], "__wx_o", ["doc_id", "piece"], "__wx_1", "__wx_rank", buckets_for(sum(counts.values())))
    table = np.array(plan, np.int64).reshape(-1, 6)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy() - 1
        top = int(table[:, 1].max(initial=0)) + int(r.max(initial=0)) + 1
        if (capacity + 1) * top < 1 << 62:
            i = np.searchsorted(table[:, 0] * top + table[:, 1], n * top + r, "right") - 1
        else:
            order = list(map(tuple, table[:, :2].tolist()))
            import bisect

            i = np.array([bisect.bisect_right(order, x) - 1 for x in zip(n.tolist(), r.tolist(), strict=True)], np.int64)
        _, rank0, k, sequence, offset, _ = table[i].T
        nth = r - rank0
        return pd.DataFrame({"sequence_id": sequence + nth // k, "offset": offset + nth % k * n})

    return ranked.withColumn("__wx_p", place("length", "__wx_rank")).select(
        *[c for c in pieces.columns if c not in ("sequence_id", "offset")], "__wx_p.sequence_id", "__wx_p.offset"
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, piece, start, length, ids, sequence_id, offset), ids as
    little-endian uint32. Null text is empty: a document always has its end id. Rows that
    repeat an id are documents of their own, with pieces of the same numbers; a null id is
    an id like others. An empty table gives an empty one; other columns are not read."""
    kind = id_type(tokenizer, end_id)
    pieces = written(tokenized_pieces(docs, tokenizer, end_id, capacity, kind), "pieces", compression="zstd")
    widen = F.pandas_udf(lambda ids: ids.map(lambda x: widened(x, kind)), "binary")
    return packed(pieces, capacity).withColumn("ids", widen("ids"))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
