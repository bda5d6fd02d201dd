"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

A shard holds some thousand documents, numbered in ascending order of doc_id. Each of its
terms is a list of postings (document, occurrences), cut into blocks of ``BLOCK``: gaps of
document numbers in one or two bytes, occurrences in one or four. Beside the compressed
block stand its last document and, for each number of occurrences in it, the least document
length; from these follows the exact maximum of the block once the corpus totals are known,
so an index of more shards needs no old one rewritten.

A shard answers a query window by window of documents. Lists are sorted by their bounds
(the largest block maximum); those whose bounds together cannot reach the present tenth
score are non-essential: they bring up no candidates. Candidates come from the others, and
a non-essential list is asked, largest bound first, only for candidates that its bound, then
its block maximum, leave in reach; only then is the block decompressed. The best of each
shard meet in one ranking per query.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import read, written

TOP, K1_TENTHS, B_PERCENT = 10, 12, 75
BLOCK = 128
#: A shard ends at so many documents or terms (repeats counted); documents are never cut.
SHARD_DOCS, SHARD_TERMS = 1 << 14, 1 << 22
#: Documents of a shard that are scored together, and queries that share a pass over a shard.
WINDOW, QUERIES = 4096, 256
#: Digits, letters (A-Z as a-z) and all bytes of other code points stay; the rest are blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
INDEX = "shard bigint, term binary, n bigint, n_terms bigint, n_filled bigint, doc_ids array<bigint>, blocks binary, impacts binary, data binary"
#: last document, end of its bytes, end of its impacts, bytes of a gap and of a count.
META = np.dtype([("last", "<u2"), ("bytes", "<u4"), ("impacts", "<u4"), ("gap", "u1"), ("tf", "u1")])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def _binary(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of bytes that follow each other in ``raw``."""
    offsets = np.concatenate(([0], ends)).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def shard_rows(shard: int, doc_ids: list, texts: list[np.ndarray], terms: list[bytes]) -> list[pa.RecordBatch]:
    """One row of a shard's documents (term null, lengths in ``data``) and one for each term."""
    names = [c.split()[0] for c in INDEX.split(", ")]
    order = sorted(range(len(doc_ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    known = [doc_ids[i] for i in order if doc_ids[i] is not None]  # null ids come after them
    head = [shard, None, len(order), int(lengths.sum()), int((lengths > 0).sum()), known, None, None, lengths.astype("<u4").tobytes()]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    rows = [pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(head, kinds, strict=True)], names)]
    if not lengths.sum():
        return rows
    keys = np.concatenate([texts[i] << 16 | at for at, i in enumerate(order)])
    keys, tf = np.unique(keys, return_counts=True)
    term, doc = keys >> 16, keys & 0xFFFF
    first = np.flatnonzero(np.diff(term, prepend=-1))  # a list's first posting
    sizes = np.diff(np.append(first, len(term)))
    in_list = np.arange(len(term)) - np.repeat(first, sizes)
    gap = np.where(in_list == 0, doc, np.diff(doc, prepend=0))
    start = np.flatnonzero(in_list % BLOCK == 0)  # a block's first posting
    count = np.diff(np.append(start, len(term)))
    meta = np.zeros(len(start), META)
    meta["last"] = doc[start + count - 1]
    meta["gap"] = np.where(np.maximum.reduceat(gap, start) > 0xFF, 2, 1)
    meta["tf"] = np.where(np.maximum.reduceat(tf, start) > 0xFF, 4, 1)
    size = count * (meta["gap"].astype(np.int64) + meta["tf"])
    block = np.repeat(np.arange(len(start)), count)
    nth = np.arange(len(term)) - start[block]
    raw, at = np.zeros(int(size.sum()), np.uint8), np.cumsum(size) - size
    for value, width, base in ((gap, meta["gap"], at), (tf, meta["tf"], at + count * meta["gap"])):
        width = width.astype(np.int64)[block]
        for byte in range(int(width.max())):
            has = width > byte
            raw[(base[block] + nth * width + byte)[has]] = (value[has] >> (8 * byte)) & 0xFF
    # For each number of occurrences in a block, the least length of its documents.
    by = np.lexsort((tf, block))
    edge = np.flatnonzero((np.diff(block[by], prepend=-1) != 0) | (np.diff(tf[by], prepend=-1) != 0))
    pairs = np.stack([tf[by][edge], np.minimum.reduceat(lengths[doc][by], edge)], 1).astype("<u4")
    upto = np.searchsorted(block[by][edge], np.arange(len(start)), "right")
    list_of = np.searchsorted(first, start, "right") - 1
    last_block = np.searchsorted(list_of, np.arange(len(first)), "right") - 1
    before = np.concatenate(([-1], last_block[:-1]))[list_of]  # last block of the list before
    ends = np.cumsum(size)
    zero = lambda x: np.where(before < 0, 0, x[before])
    meta["bytes"], meta["impacts"] = ends - zero(ends), upto - zero(upto)
    n, none = len(first), lambda k: pa.nulls(len(first), k)
    columns = [
        pa.array(np.full(n, shard), pa.int64()),
        pa.array([terms[i] for i in term[first].tolist()], pa.binary()),
        pa.array(sizes, pa.int64()),
        none(pa.int64()),
        none(pa.int64()),
        none(pa.list_(pa.int64())),
        _binary(meta, (last_block + 1) * META.itemsize),
        _binary(pairs, upto[last_block] * 8),
        _binary(raw, ends[last_block]),
    ]
    whole = pa.RecordBatch.from_arrays(columns, names)
    return rows + [whole.slice(i, 1 << 14) for i in range(0, n, 1 << 14)]


def build_index(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) to a written index of all terms of all documents. Every row is a
    document of its own; null and empty texts have no terms."""

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        ids, texts, size, vocabulary = [], [], 0, defaultdict(itertools.count().__next__)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = terms_of(text.as_py())
                ids.append(doc)
                texts.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if len(ids) == SHARD_DOCS or size >= SHARD_TERMS:
                    yield from shard_rows(shard, ids, texts, list(vocabulary))
                    ids, texts, size, vocabulary, shard = [], [], 0, defaultdict(itertools.count().__next__), shard + 1
        if ids:
            yield from shard_rows(shard, ids, texts, list(vocabulary))

    return written(docs.select("doc_id", "text").mapInArrow(run, INDEX), "lexical-index")


class Postings:
    """A list of a shard. Blocks are decompressed when asked for; until then their documents
    stand as copies of the block's last, so the array is always in order."""

    def __init__(self, n: int, blocks: bytes, impacts: bytes, data: bytes, impact):
        self.meta, self.data, self.impact = np.frombuffer(blocks, META), data, impact
        pairs = np.frombuffer(impacts, "<u4").reshape(-1, 2).astype(np.int64)
        starts = np.concatenate(([0], self.meta["impacts"][:-1])).astype(np.int64)
        self.maxima = np.maximum.reduceat(impact(pairs[:, 0], lengths=pairs[:, 1]), starts)
        self.bound = int(self.maxima.max())
        self.last = self.meta["last"].astype(np.int64)
        count = np.full(len(self.meta), BLOCK)
        count[-1] = n - BLOCK * (len(count) - 1)
        self.docs, self.scores = np.repeat(self.last, count), np.zeros(n, np.int64)
        self.open = np.zeros(len(count), bool)

    def decompress(self, blocks: np.ndarray) -> None:
        for b in blocks[~self.open[blocks]].tolist():
            s = b * BLOCK
            n = min(BLOCK, len(self.docs) - s)
            at, m = int(self.meta["bytes"][b - 1]) if b else 0, self.meta[b]
            gaps = np.frombuffer(self.data, f"<u{m['gap']}", n, at).astype(np.int64)
            tf = np.frombuffer(self.data, f"<u{m['tf']}", n, at + n * int(m["gap"])).astype(np.int64)
            docs = np.cumsum(gaps) + (self.last[b - 1] if b else 0)
            self.docs[s : s + n], self.scores[s : s + n] = docs, self.impact(tf, docs=docs)
            self.open[b] = True


def shard_top(lists: list[tuple[int, Postings]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (documents, scores) for weighted lists; equal scores by document."""
    lists = sorted(((w, p) for w, p in lists if w > 0), key=lambda x: x[0] * x[1].bound)
    reach = np.cumsum([w * p.bound for w, p in lists]).tolist()
    best, top, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for a in range(0, n_docs, WINDOW):
        end = min(n_docs, a + WINDOW)
        rest = sum(r < least for r in reach)  # lists that together stay under the least
        if rest == len(lists):
            break
        score = np.zeros(end - a, np.int64)
        for w, p in lists[rest:]:
            lo, hi = np.searchsorted(p.last, (a, end))
            p.decompress(np.arange(lo, min(hi + 1, len(p.last))))
            lo, hi = np.searchsorted(p.docs, (a, end))
            score[p.docs[lo:hi] - a] += w * p.scores[lo:hi]
        found = np.flatnonzero(score)
        for i in range(rest - 1, -1, -1):
            w, p = lists[i]
            found = found[score[found] + reach[i] >= least]
            block = np.searchsorted(p.last, found + a)
            inside = block < len(p.last)
            upper = np.where(inside, w * p.maxima[np.minimum(block, len(p.last) - 1)], 0) + (reach[i - 1] if i else 0)
            near = score[found] + upper >= least
            found, block, inside = found[near], block[near], inside[near]
            if not len(found):
                break
            p.decompress(np.unique(block[inside]))
            at = np.minimum(np.searchsorted(p.docs, found + a), len(p.docs) - 1)
            score[found] += np.where(p.docs[at] == found + a, w * p.scores[at], 0)
        found = found[score[found] >= least]
        best, top = np.concatenate([best, found + a]), np.concatenate([top, score[found]])
        order = np.lexsort((best, -top))[:k]
        best, top = best[order], top[order]
        if len(top) == k:
            least = max(1, int(top[-1]))
    return best, top


def query_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, text, ...) to (q, item_id) and (q, term, times). Rows of one item_id are one
    query; null is an id like others."""
    ids = written(items.select("item_id").distinct().select(F.monotonically_increasing_id().alias("q"), "item_id"), "queries")

    def run(batches):
        for b in batches:
            for q, text in zip(b["q"], b["text"], strict=True):
                own = Counter(terms_of(text))
                yield pd.DataFrame({"q": [q] * len(own), "term": list(own), "times": list(own.values())})

    texts = ids.withColumnRenamed("item_id", "own").join(items.select("item_id", "text"), F.col("own").eqNullSafe(F.col("item_id")))
    terms = texts.select("q", "text").mapInPandas(run, "q bigint, term binary, times bigint")
    return ids, written(terms.groupBy("q", "term").agg(F.sum("times").alias("times")), "query-terms")


def term_weight(n: int, df: Column) -> Column:
    return F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * df + 1))).cast("bigint")


def search(index: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents of ``index`` for each of ``items`` (item_id, text, ...):
    (item_id, rank, doc_id, score). Scores of 0 are left out, so an item without a known
    term has no rows. Equal scores rank by doc_id, null last; rows of one doc_id and score
    in any order. No documents, or no items: no rows."""
    heads = index.filter("term is null")
    n, total = heads.agg(F.coalesce(F.sum("n_filled"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    ids, terms = query_terms(items)
    groups = -(-ids.count() // QUERIES) or 1
    group = F.pmod(F.xxhash64("q"), F.lit(groups)).alias("group")
    postings = index.filter("term is not null").join(terms.select("term").distinct(), "term", "left_semi")
    weights = postings.groupBy("term").agg(term_weight(n, F.sum("n")).alias("w"))
    # Each term once for each group of queries, with the queries that ask for it.
    asked = terms.join(weights, "term").groupBy(group, "term", "w")
    asked = asked.agg(F.sort_array(F.collect_list(F.struct("q", "times"))).alias("a")).select("group", "term", "w", "a.q", "a.times")
    hits = postings.join(written(asked, "asked"), "term").select("shard", "group", "term", "n", "doc_ids", "blocks", "impacts", "data", "w", "q", "times")
    none = F.lit(None).cast
    docs = heads.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group"),
        "term", "n", "doc_ids", "blocks", "impacts", "data", none("bigint").alias("w"), none("array<bigint>").alias("q"), none("array<bigint>").alias("times"),
    )
    base, share = 100 - B_PERCENT, B_PERCENT

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows["term"].isna()
        own = rows[head].iloc[0]
        lengths = np.frombuffer(own["data"], "<u4").astype(np.int64)
        longer = lambda x: base + share * x * n // total
        by_doc = longer(lengths) if total else lengths

        def impact(tf, docs=None, lengths=None):
            return 1_000_000_000 * tf // (1000 * tf + 8 * (longer(lengths) if docs is None else by_doc[docs]))

        queries = defaultdict(list)
        for r in rows[~head].itertuples():
            p = Postings(r.n, r.blocks, r.impacts, r.data, impact)
            for q, times in zip(r.q, r.times, strict=True):
                queries[q].append((int(r.w) * int(times), p))
        out = [(q, *shard_top(lists, len(lengths), k)) for q, lists in queries.items()]
        ids = own["doc_ids"].tolist() + [None] * (len(lengths) - len(own["doc_ids"]))
        return pd.DataFrame(
            {
                "q": pd.Series([q for q, d, _ in out for _ in d], dtype="int64"),
                "doc_id": pd.Series([ids[i] for _, d, _ in out for i in d.tolist()], dtype="Int64"),
                "score": pd.Series([x for _, _, s in out for x in s.tolist()], dtype="int64"),
            }
        )

    best = hits.union(docs).groupBy("shard", "group").applyInPandas(answer, "q bigint, doc_id bigint, score bigint")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))
    return ranked.filter(F.col("rank") <= k).join(ids, "q").select("item_id", "rank", "doc_id", "score")


def op12_search(spark, sf_dir: str) -> DataFrame:
    """Ten documents for each benchmark item; nulls, ties, repeats and empty tables as in
    ``search``, which reads the columns doc_id, item_id and text alone."""
    index = build_index(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return search(index, read(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
c AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS times FROM i GROUP BY ALL),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(c.n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, c WHERE t IN (SELECT t FROM q) GROUP BY t),
m AS (SELECT r, doc_id, 25 + (75 * len(ts) * c.n) // c.l AS m FROM d, c WHERE len(ts) > 0),
s AS (
  SELECT item_id, doc_id, r, CAST(sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m))) AS BIGINT) AS score
  FROM p JOIN q USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL),
k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""
