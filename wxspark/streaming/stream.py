"""Structured Streaming over the raw landing folder (the hourly poll, re-aimed).

* T1 ``landing_stream``        incremental JSON file source (``availableNow`` = the cron run)
* T2 ``dedup_within_watermark`` bounded-state dedup by (city, recorded_at)
* T3 ``start_keyed_load``       exact keyed load per micro-batch (``foreachBatch`` +
                                 insert-if-absent, so a replayed batch inserts nothing twice)
* T4 ``hourly_counts``          tumbling 1-hour counts, append mode, watermark-bounded
* T5 ``latest_per_city``        per-city latest row as aggregate state, update mode
     ``start_latest_table``     the same as a table on disk, merged batch by batch

State is always bounded: T2/T4 by the watermark, T5 by the number of cities; T3 and the
latest table keep no state (the table is the state). Checkpoints go under the cluster's shared
``spark.checkpoint.dir`` unless the caller names a location.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wxspark.operators import activity, quality, transform
from wxspark.operators import load as load_op
from wxspark.session import checkpoint_dir, scratch_path
from wxspark.sources import raw_json

KEY = ("city", "recorded_at")


def landing_stream(spark: SparkSession, path: str, multiline: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw responses as they land -> parsed observations with lineage and ingest order.

    Rejected documents are dropped here; use :func:`landing_rejects` for that stream.
    """
    raw = raw_json.stream_raw(spark, path, multiline, max_files_per_trigger)
    good = raw.where(raw_json.reject_reason().isNull())
    obs = raw_json.flatten(good, keep=("source_file", "_extracted_at"))
    return transform.add_derived(obs).select(
        "*",
        F.xxhash64("source_file", "_extracted_at", "city", "recorded_at").alias("obs_id"),
        # The time of the micro-batch, which a replay of the batch keeps.
        F.current_timestamp().cast("timestamp_ntz").alias("inserted_at"),
    ).drop("_extracted_at")


def landing_rejects(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    raw = raw_json.stream_raw(spark, path, multiline)
    return raw.withColumn("reason", raw_json.reject_reason()).where(F.col("reason").isNotNull()).select(
        "source_file", "reason", F.col(raw_json.CORRUPT).alias("raw")
    )


def _event_time(df: DataFrame, col: str) -> tuple[DataFrame, str]:
    """Watermarks need TIMESTAMP (LTZ); our columns are naive UTC (NTZ) and the session
    zone is UTC, so the cast keeps the wall time."""
    name = f"_event_{col}"
    return df.withColumn(name, F.col(col).cast("timestamp")), name


def dedup_within_watermark(df: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Drop repeats of (city, recorded_at) seen within ``delay`` of the event-time watermark."""
    df, ev = _event_time(df, "recorded_at")
    return df.withWatermark(ev, delay).dropDuplicatesWithinWatermark(list(KEY)).drop(ev)


def hourly_counts(df: DataFrame, time_col: str = "extracted_at", delay: str = "1 hour") -> DataFrame:
    df, ev = _event_time(df, time_col)
    return (
        df.withWatermark(ev, delay)
        .groupBy(F.window(ev, "1 hour"))
        .agg(F.count(F.lit(1)).alias("searches"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "searches",
        )
    )


def latest_per_city(df: DataFrame) -> DataFrame:
    """Row of the greatest (recorded_at, inserted_at, -obs_id) per city as streaming aggregate
    state; the batch operator is itself one aggregate, so it runs on a stream as it is."""
    return activity.latest_per_city(df)


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or os.path.join(checkpoint_dir(spark), "streams", name)


def start_keyed_load(
    spark: SparkSession,
    stream: DataFrame,
    table_path: str,
    name: str = "keyed_load",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    stats_sink: list | None = None,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Validate each micro-batch and insert its clean rows if absent (T3). Rows that the
    rules hold back go to ``quarantine_path`` (by default beside the table), in a part of
    their own for each stream and batch, which a replay of the batch writes anew.

    A batch that is re-run after a failure finds its rows already stored and skips them,
    so the table is exact under replay without any streaming state.
    """
    location = _checkpoint(spark, name, checkpoint_location)
    held_back = os.path.join(
        quarantine_path or f"{table_path.rstrip('/')}_quarantine", f"stream={hashlib.md5(location.encode()).hexdigest()[:12]}s"
    )

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Staged once: the JSON is parsed once, and a row's position in the stage makes the
        # order of ingest (time, file, position) unique per row and the same in every branch.
        stage = os.path.join(checkpoint_dir(session), "stages", f"{name}-{uuid.uuid4().hex}")
        batch.withColumn("_position", F.monotonically_increasing_id()).write.parquet(stage)
        staged = session.read.schema(batch.schema.add("_position", "long")).parquet(stage)
        staged = staged.withColumn("_order", F.struct("extracted_at", *[c for c in ("source_file",) if c in staged.columns], "_position"))
        v = quality.validate(staged, order_col="_order")
        stats = load_op.load(session, v.clean, table_path, order_col="_order")
        v.quarantine.drop("_order", "_position").write.mode("overwrite").parquet(os.path.join(held_back, f"batch_id={batch_id}"))
        if stats_sink is not None:
            stats_sink.append((batch_id, stats))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.queryName(name).start()


# ---------------------------------------------------------------------------
# the latest row per city as a table
# ---------------------------------------------------------------------------

#: Parts of a latest table by hash of the city; a batch rewrites those its cities fall into.
LATEST_PARTS = 64


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest row per city. A part may for a while hold rows of an earlier generation
    beside those of the newest; the greatest row of a city is the same either way."""
    return activity.latest_per_city(spark.read.option("basePath", path).parquet(path).drop("part", "generation"))


def merge_latest(spark: SparkSession, batch: DataFrame, path: str, parts: int = LATEST_PARTS) -> None:
    """Merge the newest row per city of ``batch`` into the latest table at ``path``.

    Only parts that hold one of the batch's cities are read and written: as a new generation,
    after which the generations it was made from are deleted. Nothing is overwritten, so a
    failure at any point leaves every city's row in place, and merging a batch twice is
    merging it once. One writer at a time.
    """
    stage = scratch_path(spark, f"latest/{uuid.uuid4().hex}")
    activity.latest_per_city(batch).withColumn("part", F.pmod(F.xxhash64("city"), F.lit(parts)).cast("int")).write.parquet(stage)
    rows = spark.read.parquet(stage)
    touched = [r.part for r in rows.select("part").distinct().collect()]  # at most ``parts``
    if not touched:
        return
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [hpath(os.path.join(path, f"part={p}")) for p in touched]
    old = [s.getPath() for f in folders if fs.exists(f) for s in fs.listStatus(f)]
    if old:
        stored = spark.read.option("basePath", path).parquet(*[f.toString() for f in folders if fs.exists(f)])
        rows = rows.unionByName(stored.drop("generation"))
    merged = activity.latest_per_city(rows).withColumn("generation", F.lit(f"g{uuid.uuid4().hex}"))
    merged.repartition("part").write.mode("append").partitionBy("part", "generation").parquet(path)
    for generation in old:
        fs.delete(generation, True)


def start_latest_table(
    spark: SparkSession,
    stream: DataFrame,
    path: str,
    name: str = "latest",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    parts: int = LATEST_PARTS,
) -> StreamingQuery:
    """Keep the latest row per city of a stream in a table (T5): each micro-batch is reduced
    to its newest row per city and merged by :func:`merge_latest`."""
    writer = (
        stream.writeStream.foreachBatch(lambda batch, _: merge_latest(batch.sparkSession, batch, path, parts))
        .outputMode("update")
        .option("checkpointLocation", _checkpoint(spark, name, checkpoint_location))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.queryName(name).start()


def start_memory_sink(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    mode: str = "append",
    checkpoint_location: str | None = None,
) -> StreamingQuery:
    """Run a streaming frame into an in-memory table (tests, notebooks)."""
    return (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", _checkpoint(spark, name, checkpoint_location))
        .trigger(availableNow=True)
        .start()
    )
