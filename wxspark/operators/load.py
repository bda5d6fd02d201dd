"""Keyed, idempotent load: insert-if-absent by (city, recorded_at), first row wins.

Storage is a parquet table partitioned by ``date`` (path-based, no metastore needed).
The key is enforced by the operator, not by storage:

1. rows with a NULL key fail (the key columns are NOT NULL in the stored layout);
2. within the batch, only the first row (smallest ``order_col``) of a key survives:
   a pre-aggregated ``min(order)`` per repeated key joined back (skew-safe, see quality);
3. keys already stored are removed: the stored side is read with only the key columns
   and ``date``; a left-semi join on (keys, date) against the batch lets Catalyst prune
   stored partitions to the batch's dates (dynamic partition pruning); the distinct hits
   are joined back, so a key that is stored twice doesn't multiply the batch.

Loading the same batch twice leaves the table unchanged; the counts of each load are
exact: ``inserted + skipped + failed = batch rows``.
Limitation: exact for one writer at a time (no cross-writer transaction on plain files).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wxspark.operators import quality, transform

KEY = ("city", "recorded_at")
#: Rows of a batch that share a file of their date, about; a date with more is dealt out to
#: more files, one with fewer has one.
ROWS_PER_FILE = 4_000_000


def classify(batch: DataFrame, existing: DataFrame | None, keys=KEY, order_col: str = "obs_id") -> DataFrame:
    """Batch + ``_load_status`` in {inserted, skipped, failed} (lazy, no action)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    marked = quality.mark_duplicates(batch, keys, order_col, flag="_in_batch_dup")
    if existing is not None:
        probe_cols = [*keys, "date"] if "date" in existing.columns and "date" in batch.columns else list(keys)
        hits = existing.select(*probe_cols).join(batch.select(*probe_cols), probe_cols, "left_semi")
        marked = marked.join(hits.select(*keys).distinct().withColumn("_stored", F.lit(True)), list(keys), "left")
    else:
        marked = marked.withColumn("_stored", F.lit(None).cast("boolean"))
    status = (
        F.when(null_key, "failed")
        .when(F.col("_in_batch_dup") | F.coalesce(F.col("_stored"), F.lit(False)), "skipped")
        .otherwise("inserted")
    )
    return marked.withColumn("_load_status", status).drop("_in_batch_dup", "_stored")


def stats_frame(classified: DataFrame) -> DataFrame:
    """One row: inserted / skipped / failed counts."""
    s = F.col("_load_status")
    return classified.agg(
        F.count_if(s == "inserted").alias("inserted"),
        F.count_if(s == "skipped").alias("skipped"),
        F.count_if(s == "failed").alias("failed"),
    )


def insert_if_absent(batch: DataFrame, existing: DataFrame | None, keys=KEY, order_col: str = "obs_id") -> DataFrame:
    """Rows of ``batch`` that the load would add to ``existing`` (lazy)."""
    c = classify(batch, existing, keys, order_col)
    return c.where(F.col("_load_status") == "inserted").drop("_load_status")


# ---------------------------------------------------------------------------
# persistent table
# ---------------------------------------------------------------------------

def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))) or (
        fs.exists(hpath) and len(fs.listStatus(hpath)) > 0
    )


def create_table(spark: SparkSession, path: str, schema) -> None:
    """Idempotent: an empty partitioned table is written only when none exists."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("append").partitionBy("date").parquet(path)


def _empty_table(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None) or exc.getErrorClass
    return cond() == "UNABLE_TO_INFER_SCHEMA"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The stored table. A table created but still empty has no data file to take the
    schema from: it reads as an empty frame of ``schema`` when one is given."""
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as exc:
        if schema is not None and _empty_table(exc):
            return spark.createDataFrame([], schema)
        raise


def conform(batch: DataFrame, existing: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``batch`` in the columns of the stored table: those it lacks are NULL of the stored
    type; a column that the table lacks is an error, not a silent loss."""
    unknown = [c for c in batch.columns if c not in existing.columns and c not in extra]
    if unknown:
        raise ValueError(f"the stored table has no columns {unknown}")
    filled = [F.col(c) if c in batch.columns else F.lit(None).cast(t).alias(c) for c, t in existing.dtypes]
    return batch.select(*filled, *[c for c in extra if c not in existing.columns])


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, None where there is none or it has no row yet."""
    if not table_exists(spark, path):
        return None
    try:
        return read_table(spark, path)
    except AnalysisException as exc:
        if _empty_table(exc):
            return None
        raise


def deal_by_date(rows: DataFrame, batch: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``rows`` dealt out for a write by date: each date to as many parts as the rows that
    ``batch`` has for it ask for. The counts are one row a date."""
    per_date = batch.groupBy(F.col("date").alias("_date")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("bigint").alias("_parts")
    )
    sized = rows.join(per_date, F.col("date").eqNullSafe(F.col("_date")), "left").drop("_date")
    part = F.pmod(F.xxhash64("id", *[k for k in ("obs_id",) if k in rows.columns]), F.greatest(F.coalesce("_parts", F.lit(1)), F.lit(1)))
    return sized.withColumn("_part", part).repartition("date", "_part").drop("_parts", "_part")


def load(
    spark: SparkSession, df: DataFrame, path: str, run_ts=None, keys=KEY, order_col: str = "obs_id", rows_per_file: int = ROWS_PER_FILE
) -> dict:
    """Append the new rows of ``df`` (observation layout) to the table at ``path``.

    ``inserted_at`` is ``run_ts`` unless the frame already carries one. Returns exact
    counts, observed on the same pass that writes (no second scan of the batch).
    """
    batch = df
    if "inserted_at" not in batch.columns:
        batch = batch.withColumn("inserted_at", F.lit(run_ts).cast("timestamp_ntz"))
    batch = transform.to_stored(batch, keep=tuple(dict.fromkeys((*transform.CARRIED_COLUMNS, order_col))))
    existing = existing_table(spark, path)
    if existing is not None:
        batch = conform(batch, existing, extra=(order_col,))
    classified = classify(batch, existing, keys, order_col)
    obs = Observation("load_stats")
    s = F.col("_load_status")
    spare = [c for c in (order_col,) if c not in transform.CARRIED_COLUMNS]
    # Before the rows are counted: a shuffle that turns out empty would take the counts away.
    dealt = deal_by_date(classified, batch, rows_per_file)
    observed = dealt.observe(
        obs,
        F.count_if(s == "inserted").alias("inserted"),
        F.count_if(s == "skipped").alias("skipped"),
        F.count_if(s == "failed").alias("failed"),
    )
    observed.where(s == "inserted").drop("_load_status", *spare).write.mode("append").partitionBy("date").parquet(path)
    got = obs.get
    return {k: int(got.get(k, 0)) for k in ("inserted", "skipped", "failed")}
