"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source is a queue of its documents in shuffled order (by the md5 of doc_id), repeated
up to ``max_repeats`` times. A document's virtual finish time is the words its source has
queued up to and with it, divided by the source's target. All queues are served in the
order of finish time until the budget of words is spent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import WORD, buckets_for, read, running_total, without, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_share: float = 1.0, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(__wx_key, source_size) to (__wx_key, source_size, target); one row per source.

    Sources weigh ``weights`` in turn, by code point, and share the budget. A target stops
    at ``max_repeats`` times its source; the excess is reshared. Sorted by that stop over
    the weight, the level L of the shares (share = L * weight) is the largest of what is
    left after the first k stops, divided by the weights that follow.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(Window.orderBy("__wx_key")) - 1) % len(weights) + 1)
    s = sizes.withColumn("__wx_w", w).withColumn("__wx_cap", (F.col("source_size") * max_repeats).cast("double"))
    whole = Window.partitionBy()
    s = s.withColumn("__wx_t", F.sum("source_size").over(whole) * F.lit(float(budget_share)))
    by_stop = Window.orderBy(F.col("__wx_cap") / F.col("__wx_w"), "__wx_key")
    before = F.coalesce(F.sum("__wx_cap").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("__wx_w").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("__wx_l", (F.col("__wx_t") - before) / rest)
    s = s.withColumn("__wx_l", F.max("__wx_l").over(whole))
    return s.select("__wx_key", "source_size", F.least("__wx_cap", F.col("__wx_l") * F.col("__wx_w")).alias("target"))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source, anything else) with size and the working columns
    __wx_key (source) and __wx_o (shuffled order)."""
    return (
        without(docs, "size", "source_size", "target", "passes", "taken")
        .withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"))
        .withColumn("__wx_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("~")))
        .withColumn("__wx_o", F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    )


def mix_sources(docs: DataFrame, weights=WEIGHTS, budget_share: float = 1.0, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` (doc_id, text, source, anything else) with size, source_size, target,
    passes (how often the mix takes the document) and taken (size * passes).

    The budget is ``budget_share`` of all words. Null text has size 0; documents without
    words are never taken. Null is a source of its own, the last. A null doc_id shuffles
    as one value; of repeated ids the smaller goes first. Documents with one finish time
    are taken together or not at all. Input columns with the names of computed ones are
    replaced. An empty table gives an empty one.
    """
    d = measured(docs)
    sizes = written(d.select("doc_id", "size", "__wx_key", "__wx_o"), "measured")
    return served(d, sizes, weights, budget_share, max_repeats)


def served(d: DataFrame, measures: DataFrame, weights=WEIGHTS, budget_share: float = 1.0, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``d``, rows of ``measured``, as ``mix_sources`` returns them. ``measures`` are the
    same rows without their texts, written: all totals come from these."""
    buckets = buckets_for(measures.count())
    sizes = measures.groupBy("__wx_key").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, budget_share, max_repeats)
    queue = lambda x: running_total(x, ["__wx_key"], "__wx_o", ["doc_id", "size"], "size", "__wx_c", buckets, measures).join(targets, "__wx_key")

    def finish(e):
        return (F.lit(e) * F.col("source_size") + F.col("__wx_c")) / F.col("target")

    # Range sort by finish time: bins of equal virtual time hold like numbers of words, so
    # their totals find the bin in which the budget ends, and only that bin is sorted.
    bins = 2 * buckets
    bin_of = lambda f: F.floor(F.least(f, F.lit(2.0)) * bins)
    asked = (F.col("size") > 0) & (F.col("target") > 0)
    items = (
        queue(measures)
        .filter(asked)
        .select("size", F.explode(F.array(*[finish(e) for e in range(max_repeats)])).alias("f"))
        .withColumn("bin", bin_of(F.col("f")))
    )
    budget = sizes.agg((F.coalesce(F.sum("source_size"), F.lit(0)) * F.lit(float(budget_share))).alias("t"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    totals = items.groupBy("bin").agg(F.sum("size").alias("s")).withColumn("upto", F.sum("s").over(upto)).crossJoin(F.broadcast(budget))  # one row
    last = totals.filter("upto > t").orderBy("bin").select("bin", "t", (F.col("upto") - F.col("s")).alias("base")).limit(1).collect()
    if last:
        edge, left = last[0]["bin"], last[0]["t"] - last[0]["base"]
        run = F.sum("size").over(Window.orderBy("f").rangeBetween(Window.unboundedPreceding, 0))
        cut = items.filter(F.col("bin") == edge).select("f", run.alias("run")).filter(F.col("run") <= left).agg(F.max("f")).first()[0]
        cut = -1.0 if cut is None else cut
        taken = lambda f: (bin_of(f) < edge) | ((bin_of(f) == edge) & (f <= F.lit(cut)))
    else:
        taken = lambda f: f.isNotNull()
    passes = sum((F.when(asked & taken(finish(e)), 1).otherwise(0) for e in range(1, max_repeats)), F.when(asked & taken(finish(0)), 1).otherwise(0))
    return (
        queue(d)
        .withColumn("passes", passes.cast("int"))
        .withColumn("taken", F.col("size") * F.col("passes"))
        .drop("__wx_key", "__wx_o", "__wx_c")
    )


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = measured(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    # Texts are read once: the result needs no more of them than their sizes.
    sizes = written(docs.drop("text", "source"), "measured")
    return served(sizes, sizes).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS DOUBLE) AS cap,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
     - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM s),
t AS (SELECT source, source_size, least(cap, (SELECT max(lv) FROM l) * w) AS target FROM l),
q AS (
  SELECT d.doc_id, d.size, d.o, t.source_size, t.target, row_number() OVER () AS r,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS c
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (
  SELECT r, size, (e * source_size + c) / target AS f FROM q, (VALUES (0), (1), (2)) AS x(e) WHERE size > 0 AND target > 0),
k AS (SELECT r, size, sum(size) OVER (ORDER BY f) AS run FROM i),
n AS (SELECT r, sum(size) AS taken FROM k WHERE run <= (SELECT sum(size) FROM d) GROUP BY r)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN n USING (r)
"""
