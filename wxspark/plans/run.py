"""Run driver: landing JSON -> observations -> quality -> keyed load -> reports.

``run_batch`` reads the whole landing folder; ``run_incremental`` (the scheduled hourly run,
G1) reads only files that no earlier run has finished, as an ``availableNow`` file stream
whose checkpoint lists them. Both take a set of files through the same steps, and both
end in a status: SUCCESS, FAILED (a stage left nothing), ERROR or INTERRUPTED.

Stage statistics (G2) come from ``DataFrame.observe`` on the passes that do the work. The
raw rows and the validated rows are written once to the shared checkpoint folder and read
back: that cuts the lineage (JSON parsing and the duplicate join run once) and, unlike a
cache, survives the loss of executors.

What validation finds is kept per run, in folders ``<name>/run_id=<run>/batch=<n>`` below
the output folder: ``quarantine``, ``rejects``, ``warnings``, ``null_counts``, ``rule_stats``,
``issue_samples`` and ``processed`` (CSV); ``validation_summary``, ``validation_issues`` and
``validation_nulls`` are one JSON folder a run. Repeating a run replaces its own folders only.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wxspark.operators import activity, quality, reports, transform
from wxspark.operators import load as load_op
from wxspark.session import ensure_session, scratch_path
from wxspark.sources import raw_json, sinks


@dataclass
class RunResult:
    status: str
    run_id: str
    stages: dict = field(default_factory=dict)
    outputs: dict = field(default_factory=dict)
    error: str | None = None

    def add(self, stage: str, counts: dict) -> None:
        """Add a batch's counts to those of the stage."""
        have = self.stages.setdefault(stage, {})
        for k, v in counts.items():
            have[k] = have.get(k, 0) + int(v)

    def metrics_frame(self, spark: SparkSession) -> DataFrame:
        """(run_id, stage, metric, value) rows of this run."""
        rows = [(self.run_id, s, m, float(v)) for s, ms in self.stages.items() for m, v in ms.items() if isinstance(v, (int, float))]
        return spark.createDataFrame(rows, "run_id string, stage string, metric string, value double")


class _Stop(Exception):
    """A stage left nothing for the next: the run has FAILED."""

    def __init__(self, stage: str, reason: str):
        super().__init__(reason)
        self.stage, self.reason = stage, reason


def observations(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations with ``obs_id``/``ingest_seq``, rejects) of raw rows with their lineage.

    ``obs_id`` hashes the file and the record, so it is the same in each run and however the
    files are dealt to tasks; a record that a file repeats word for word repeats its id.
    ``ingest_seq`` is unique: "first" among repeated keys is the earliest extraction, then
    file, then position in the file.
    """
    record = F.to_json(F.struct(*raw_json.RAW.fieldNames()))
    good, bad = raw_json.split_raw(
        raw.withColumn("_record", F.xxhash64("source_file", record)),
        keep=("source_file", "block_start", "raw_pos", "_extracted_at", "_record"),
    )
    obs = transform.add_derived(good).select(
        "*",
        F.col("_record").alias("obs_id"),
        F.struct("extracted_at", "source_file", "block_start", "raw_pos").alias("ingest_seq"),
    )
    return obs.drop("_extracted_at", "_record"), bad.drop("_record")


def ingest(
    spark: SparkSession, landing: str, multiline: bool = False, stage_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(observations with ``obs_id``/``ingest_seq``, rejects) from the landing folder.

    With ``stage_path`` the landing JSON is parsed once into a parquet stage there and
    both outputs read the stage: the JSON is not parsed a second time for the rejects,
    and the read position ``raw_pos`` is fixed once for both.
    """
    raw = raw_json.read_raw(spark, landing, multiline)
    if stage_path is not None:
        raw.write.mode("overwrite").parquet(stage_path)
        raw = spark.read.parquet(stage_path)
    return observations(raw)


@dataclass
class _Run:
    """Where a run reads and writes, and the steps that a set of files goes through."""

    spark: SparkSession
    table: str
    out: str
    run_ts: datetime
    result: RunResult

    def scratch(self, name: str, batch: int | None = None) -> str:
        part = f"{name}/run_id={self.result.run_id}"
        return scratch_path(self.spark, part if batch is None else f"{part}/batch={batch}")

    def kept(self, name: str, batch: int | None = None) -> str:
        part = os.path.join(self.out, name, f"run_id={self.result.run_id}")
        return part if batch is None else os.path.join(part, f"batch={batch}")

    def take(self, raw: DataFrame, batch: int) -> quality.Validation:
        """Extract, transform and validate ``raw`` (rows of :func:`raw_json.read_raw`)."""
        spark, result = self.spark, self.result
        raw.write.mode("overwrite").parquet(self.scratch("raw", batch))
        staged = spark.read.parquet(self.scratch("raw", batch))
        got = staged.agg(F.count(F.lit(1)).alias("records_fetched"), F.count_distinct("source_file").alias("files")).first()
        result.add("extract", got.asDict())

        obs, bad = observations(staged)
        rejected, seen = Observation(), Observation()
        bad.observe(rejected, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(self.kept("rejects", batch))
        v = quality.validate(obs.withColumn("inserted_at", F.lit(self.run_ts).cast("timestamp_ntz")), order_col="ingest_seq")
        flagged = v.flagged.drop("ingest_seq").observe(seen, F.count(F.lit(1)).alias("n"))
        flagged.write.mode("overwrite").parquet(self.scratch("flagged", batch))
        result.add(
            "transform",
            {"records_in": got.records_fetched, "records_rejected": rejected.get.get("n", 0), "records_out": seen.get.get("n", 0)},
        )
        v = v.with_flagged(spark.read.parquet(self.scratch("flagged", batch)))
        v.columns = [c for c in v.columns if c != "ingest_seq"]
        result.stages["transform"]["columns"] = len(v.columns)

        ledger = {
            "rule_stats": quality.rule_stats(v.flagged, v.rules, v.id_col),
            "issue_samples": v.samples(),
            "null_counts": v.null_counts(),
            "warnings": v.warnings,
            "quarantine": v.quarantine,
        }
        for name, frame in ledger.items():
            frame.write.mode("overwrite").parquet(self.kept(name, batch))
        sinks.write_csv(transform.final_projection(v.flagged, keep=()), self.kept("processed", batch))
        return v

    def judge(self, rules: list[quality.Rule]) -> None:
        """Summary, issues and NULL counts of the run from what its batches left."""
        read = lambda name: self.spark.read.parquet(self.kept(name)).drop("batch")
        stats = quality.merge_stats(read("rule_stats"))
        summary = quality.summary_from_stats(stats, rules)
        self.result.stages["validate"] = row = summary.first().asDict()
        sinks.write_json(summary, self.kept("validation_summary"))
        samples = quality.smallest_rows(read("issue_samples"))
        sinks.write_json(quality.with_samples(quality.issues_from_stats(stats, rules), samples), self.kept("validation_issues"))
        nulls = read("null_counts").groupBy("column").agg(F.sum("null_count").alias("null_count"))
        sinks.write_json(nulls, self.kept("validation_nulls"))
        self.result.outputs["validation"] = self.kept("validation_summary")
        if row["original_record_count"] == 0:
            raise _Stop("validate", "no records")
        if row["clean_record_count"] == 0:
            raise _Stop("validate", "no clean records")

    def report(self, source: DataFrame) -> None:
        """The reports, over a roll-up that reads ``source`` once."""
        path = self.scratch("rollup")
        frames = reports.generate_all_reports(source, path)
        meta = reports.metadata_from_rollup(self.spark.read.parquet(path))
        written = sinks.export_reports(frames, self.kept("reports"), run_ts=self.run_ts, total_records=meta)
        self.result.stages["report"] = {"reports_written": len(written)}
        self.result.outputs["reports"] = written


def _guarded(run: _Run, work: Callable[[], None]) -> RunResult:
    """Do ``work`` and set the run's status by how it ended."""
    result = run.result
    try:
        work()
        result.status = "SUCCESS"
    except _Stop as stop:
        result.status = "FAILED"
        result.stages.setdefault(stop.stage, {})["reason"] = stop.reason
    except KeyboardInterrupt:
        result.status = "INTERRUPTED"
    except Exception as exc:  # noqa: BLE001 - the caller reads status and error
        result.status, result.error = "ERROR", str(exc)
    return result


def _new_run(spark: SparkSession, table_path: str, out_dir: str, run_ts: datetime | None) -> _Run:
    ensure_session(spark)
    run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    return _Run(spark, table_path, out_dir, run_ts, RunResult(status="RUNNING", run_id=sinks.run_stamp_literal(run_ts)))


def run_batch(
    spark: SparkSession,
    landing: str,
    table_path: str,
    out_dir: str,
    run_ts: datetime | None = None,
    multiline: bool = False,
) -> RunResult:
    """One run over the whole landing folder. A load that fails is reported and the reports
    are made of the clean rows; the next run finds the same files again."""
    run = _new_run(spark, table_path, out_dir, run_ts)

    def work() -> None:
        v = run.take(raw_json.read_raw(spark, landing, multiline), batch=0)
        run.judge(v.rules)
        try:
            run.result.add("load", load_op.load(spark, v.clean, table_path, run_ts=run.run_ts))
            source = load_op.read_table(spark, table_path)
        except Exception as exc:  # noqa: BLE001 - a store outage must not lose the reports
            run.result.stages["load"] = {"error": str(exc)}
            source = transform.to_stored(v.clean)
        run.report(source)

    return _guarded(run, work)


def run_incremental(
    spark: SparkSession,
    landing: str,
    table_path: str,
    out_dir: str,
    run_ts: datetime | None = None,
    multiline: bool = False,
    state_path: str | None = None,
    max_files_per_trigger: int | None = None,
) -> RunResult:
    """One run over the files that no earlier run with this ``state_path`` (by default beside
    the table) has finished.

    A file counts as finished once its rows are loaded: a failure before, the load's
    included, is an ERROR, and the next run takes the same files again; rows that were
    stored already are skipped by key. No new file is a FAILED run, as is an empty folder.
    """
    run = _new_run(spark, table_path, out_dir, run_ts)
    state = state_path or f"{table_path.rstrip('/')}_landing_state"
    rules = quality.default_rules()

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        v = run.take(batch.withColumn("raw_pos", F.monotonically_increasing_id()), batch_id)
        run.result.add("load", load_op.load(spark, v.clean, table_path, run_ts=run.run_ts))

    def work() -> None:
        files = raw_json.stream_raw(spark, landing, multiline, max_files_per_trigger)
        query = files.writeStream.foreachBatch(per_batch).option("checkpointLocation", state).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            query.stop()
        if not run.result.stages.get("extract", {}).get("records_fetched"):
            raise _Stop("extract", "no new records")
        run.judge(rules)
        run.report(load_op.read_table(spark, table_path))

    return _guarded(run, work)


def export_observations(stored: DataFrame, path: str) -> None:
    """The whole table as ordered CSV files, newest reading first."""
    sinks.export_table(stored, path, activity.newest_first())


def search_analytics(stored: DataFrame) -> dict[str, DataFrame]:
    """The four activity frames of the dashboard (G3), lazily."""
    return {
        "recent_searches": activity.recent_searches(stored),
        "city_search_counts": activity.city_search_counts(stored),
        "top5_cities": activity.top_cities(stored),
        "activity_over_time": activity.hourly_activity(stored),
    }


def live_lookup(requests: DataFrame, stored: DataFrame, as_of) -> DataFrame:
    """Bulk live fetch (G4): which requested cities can be served from a fresh stored row."""
    return activity.fresh_city_bulk(requests, stored, F.lit(as_of).cast("timestamp_ntz"))


def live_fetch(spark: SparkSession, requests: DataFrame, docs: DataFrame, table_path: str, now: datetime) -> tuple[DataFrame, dict]:
    """Answer requested cities from the table where a row is fresh; take the others from
    ``docs``, store them and answer with what was stored (G4, L6).

    ``requests`` has a ``city``; ``docs`` has (``city``, ``doc``): the response fetched for
    a requested city, as JSON text. Only documents of stale cities are parsed. Returns
    (requested_city, status, stored row) with status ``fresh``, ``fetched`` or ``missing``
    (no usable document; the row is NULL), and the counts of the load. City names are
    compared without regard to case; the stored name is the document's.
    """
    ensure_session(spark)
    as_of = F.lit(now).cast("timestamp_ntz")
    stored = load_op.existing_table(spark, table_path)
    if stored is None:
        stored = spark.createDataFrame([], transform.STORED_LAYOUT)
    work = scratch_path(spark, f"live/{uuid.uuid4().hex}")
    activity.fresh_city_bulk(requests, stored, as_of).write.parquet(f"{work}/split")
    split = spark.read.parquet(f"{work}/split")

    stale = split.where("status = 'stale'").select(F.lower("requested_city").alias("_key")).distinct()
    wanted = docs.select(F.lower("city").alias("_key"), "doc").distinct().join(stale, "_key", "left_semi")
    parsed = raw_json.parse_docs(wanted.withColumn("obs_id", F.xxhash64("_key", "doc", as_of)), F.col("doc"), keep=("_key", "obs_id"))
    raw_json.flatten_live(parsed, as_of, keep=("_key", "obs_id")).write.parquet(f"{work}/fetched")
    fetched = spark.read.parquet(f"{work}/fetched")
    counts = load_op.load(spark, fetched.drop("_key"), table_path, run_ts=now)

    answer = fetched.groupBy("_key").agg(F.min(F.struct("obs_id", transform.surrogate_key().alias("id"))).alias("a"))
    named = split.select(
        "requested_city", F.lower("requested_city").alias("_key"), F.col("id").alias("_fresh_id")
    ).join(answer, "_key", "left").select(
        "requested_city",
        F.when(F.col("_fresh_id").isNotNull(), "fresh").when(F.col("a.id").isNotNull(), "fetched").otherwise("missing").alias("status"),
        F.coalesce("_fresh_id", "a.id").alias("_id"),
    )
    table = load_op.existing_table(spark, table_path)
    rows = stored if table is None else table
    return named.join(rows, F.col("_id") == F.col("id"), "left").drop("_id"), counts


def main(argv: list[str] | None = None) -> int:
    """``spark-submit -m``-style entry: one run over the new files of a landing folder.

    Uses the session the cluster provides (master, memory, ``spark.checkpoint.dir``);
    exit code 0 only on SUCCESS.
    """
    import argparse
    import json

    from wxspark.session import build_session

    ap = argparse.ArgumentParser(prog="wxspark-run", description=__doc__)
    ap.add_argument("landing", help="folder of raw JSON responses (JSON lines, or arrays with --multiline)")
    ap.add_argument("table", help="stored observation table (parquet, partitioned by date)")
    ap.add_argument("out", help="folder for validation outputs and report exports")
    ap.add_argument("--multiline", action="store_true", help="landing files are pretty-printed JSON arrays")
    ap.add_argument("--full", action="store_true", help="read the whole folder, whatever earlier runs finished")
    ap.add_argument("--export", help="folder for the whole table as ordered CSV files")
    ap.add_argument("--run-ts", help="run timestamp (ISO, UTC); default now")
    args = ap.parse_args(argv)
    spark = build_session(app_name="wxspark-run")
    run_ts = datetime.fromisoformat(args.run_ts) if args.run_ts else None
    run = run_batch if args.full else run_incremental
    result = run(spark, args.landing, args.table, args.out, run_ts=run_ts, multiline=args.multiline)
    if args.export and result.status == "SUCCESS":
        export_observations(load_op.read_table(spark, args.table), args.export)
    print(json.dumps({"status": result.status, "run_id": result.run_id, "stages": result.stages, "error": result.error}, default=str))
    return 0 if result.status == "SUCCESS" else 1


if __name__ == "__main__":
    raise SystemExit(main())
