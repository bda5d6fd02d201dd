"""Incremental runs, run-keyed validation output, live insert, roll-up, samples, layout, export."""

import glob
import math
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from wxspark.operators import activity, quality, reports, transform
from wxspark.operators import load as L
from wxspark.plans import run as R
from wxspark.plans import views as V
from wxspark.sources import raw_json, sinks
from wxspark.streaming import stream as S

EARLY, LATE = "inserted_at < '2024-01-15'", "inserted_at >= '2024-01-15'"


def land(spark, path, where="true"):
    o = V.obs(spark, SF_SMALL).where(where)
    docs = o.select(raw_json.observation_to_raw(o).alias("doc"), F.col("inserted_at").alias("ingest_ts"))
    sinks.write_landing(docs, path)
    return o.count()


def keys(df):
    return sorted(map(tuple, df.select("city", "recorded_at", "temperature_c").collect()), key=str)


@pytest.fixture()
def no_reports(monkeypatch):
    """Runs without their reports, which test_run.py covers."""
    monkeypatch.setattr(R._Run, "report", lambda run, source: None)


def test_incremental_run_reads_only_new_files(spark, tmp_dir, no_reports):
    landing, table, out = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/out"
    early = land(spark, landing, EARLY)
    first = R.run_incremental(spark, landing, table, out, run_ts=datetime(2024, 2, 1))
    assert first.status == "SUCCESS", first
    assert first.stages["extract"]["records_fetched"] == early
    late = land(spark, landing, LATE)
    broken = os.path.join(landing, "ingest_date=2024-02-01")
    os.makedirs(broken)
    with open(os.path.join(broken, "broken.json"), "w") as f:
        f.write('{"name": "Kolkata", \n')
    second = R.run_incremental(spark, landing, table, out, run_ts=datetime(2024, 2, 1, 1))
    got = second.stages
    assert got["extract"]["records_fetched"] == late + 1 and got["transform"]["records_rejected"] == 1
    assert got["transform"]["records_in"] == got["transform"]["records_rejected"] + got["transform"]["records_out"]
    assert got["validate"]["original_record_count"] == late == got["transform"]["records_out"]
    assert sum(got["load"].values()) == got["validate"]["clean_record_count"]
    # nothing new: the files are not read again
    third = R.run_incremental(spark, landing, table, out, run_ts=datetime(2024, 2, 1, 2))
    assert third.status == "FAILED" and third.stages["extract"]["reason"] == "no new records"
    # the table equals that of one run over everything
    whole = R.run_batch(spark, landing, f"{tmp_dir}/whole", f"{tmp_dir}/out2", run_ts=datetime(2024, 2, 1))
    assert whole.status == "SUCCESS"
    assert keys(L.read_table(spark, table)) == keys(L.read_table(spark, f"{tmp_dir}/whole"))
    # both runs are kept, and each repeats only itself
    assert {r.run_id for r in spark.read.parquet(f"{out}/quarantine").select("run_id").distinct().collect()} == {
        "20240201_000000", "20240201_010000"}
    processed = spark.read.option("header", True).csv(f"{tmp_dir}/out2/processed/run_id=20240201_000000/batch=0")
    assert processed.columns == list(transform.FINAL_COLUMNS) and processed.count() == early + late


def test_a_repeated_run_replaces_its_own_output_only(spark, tmp_dir, no_reports):
    os.makedirs(f"{tmp_dir}/l")
    with open(f"{tmp_dir}/l/a.json", "w") as f:
        f.write('{"name": "Oslo", "dt": 1700000000}\n')  # no temperature: held back
    for hour in (0, 1, 1):
        res = R.run_batch(spark, f"{tmp_dir}/l", f"{tmp_dir}/t", f"{tmp_dir}/o", run_ts=datetime(2024, 2, 1, hour))
        assert res.status == "FAILED" and res.stages["validate"]["reason"] == "no clean records"
    rows = spark.read.parquet(f"{tmp_dir}/o/quarantine").groupBy("run_id").count().collect()
    assert {(r.run_id, r["count"]) for r in rows} == {("20240201_000000", 1), ("20240201_010000", 1)}


def test_batches_of_one_run_add_up_to_the_whole(spark, tmp_dir, no_reports):
    landing = f"{tmp_dir}/landing"
    land(spark, landing)
    parts = R.run_incremental(spark, landing, f"{tmp_dir}/t", f"{tmp_dir}/o", run_ts=datetime(2024, 2, 1), max_files_per_trigger=20)
    assert parts.status == "SUCCESS", parts
    assert len(glob.glob(f"{tmp_dir}/o/rule_stats/run_id=*/batch=*")) > 1
    flagged = spark.read.parquet(R.scratch_path(spark, "flagged/run_id=20240201_000000")).drop("batch")
    rules = quality.default_rules()
    expected = quality.summary_frame(flagged, rules).first().asDict()
    assert parts.stages["validate"] == expected
    issues = {r.rule_order: (r.affected_rows, r.sample_ids) for r in quality.issues_frame(flagged, rules).collect()}
    written = spark.read.json(f"{tmp_dir}/o/validation_issues/run_id=20240201_000000").collect()
    assert {r.rule_order: (r.affected_rows, r.sample_ids) for r in written} == issues
    warned = spark.read.parquet(f"{tmp_dir}/o/warnings")
    assert warned.count() == flagged.where("not critical and (f_range_pressure_hpa or f_short_city)").count() > 0


def test_failed_load_leaves_the_files_to_the_next_run(spark, tmp_dir, no_reports):
    landing, blocked = f"{tmp_dir}/landing", f"{tmp_dir}/not_a_table"
    n = land(spark, landing, EARLY)
    with open(blocked, "w") as f:  # a plain file where the table folder should be
        f.write("x")
    state = f"{tmp_dir}/state"
    bad = R.run_incremental(spark, landing, blocked, f"{tmp_dir}/o", run_ts=datetime(2024, 2, 1), state_path=state)
    assert bad.status == "ERROR" and bad.error
    good = R.run_incremental(spark, landing, f"{tmp_dir}/t", f"{tmp_dir}/o", run_ts=datetime(2024, 2, 1, 1), state_path=state)
    assert good.status == "SUCCESS" and good.stages["extract"]["records_fetched"] == n


def test_interrupted_and_failing_runs_have_a_status(spark, tmp_dir, monkeypatch):
    land(spark, f"{tmp_dir}/landing", EARLY)

    def stop(*a, **k):
        raise KeyboardInterrupt

    monkeypatch.setattr(R.quality, "validate", stop)
    assert R.run_batch(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/o").status == "INTERRUPTED"
    long = "x" * 2000
    monkeypatch.setattr(R.quality, "validate", lambda *a, **k: (_ for _ in ()).throw(ValueError(long)))
    res = R.run_batch(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/o")
    assert res.status == "ERROR" and res.error == long


def test_ids_and_order_do_not_depend_on_how_files_are_packed(spark, tmp_dir):
    land(spark, f"{tmp_dir}/landing")

    def ids():
        obs, _ = R.ingest(spark, f"{tmp_dir}/landing")
        rows = obs.select("obs_id", "city", "recorded_at", F.struct("ingest_seq.extracted_at", "ingest_seq.source_file", "ingest_seq.block_start").alias("s")).collect()
        return sorted(map(str, rows))

    before = ids()
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert ids() == before and len(set(before)) == 1000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_documents_without_extraction_time_are_stamped_by_their_file(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/l")
    with open(f"{tmp_dir}/l/a.json", "w") as f:
        f.write('{"name": "Oslo", "dt": 1700000000}\n{"name": "Oslo", "dt": 1700000000, "_extracted_at": "2024-01-02T03:04:05.123"}\n')
    when = datetime(2024, 1, 5, 6, 7, 8)
    os.utime(f"{tmp_dir}/l/a.json", (when.timestamp() - (when - datetime.fromtimestamp(when.timestamp())).total_seconds(),) * 2)
    expected = datetime.utcfromtimestamp(int(os.stat(f"{tmp_dir}/l/a.json").st_mtime))
    good, _ = raw_json.split_raw(raw_json.read_raw(spark, f"{tmp_dir}/l"))
    stamps = {r.extracted_at for r in good.collect()}
    assert stamps == {expected, datetime(2024, 1, 2, 3, 4, 5)}
    q = S.start_memory_sink(spark, S.landing_stream(spark, f"{tmp_dir}/l"), "stamped", checkpoint_location=f"{tmp_dir}/ck")
    q.awaitTermination()
    assert {r.extracted_at for r in spark.table("stamped").collect()} == stamps


def test_live_fetch_stores_stale_cities_once(spark, tmp_dir):
    table, now = f"{tmp_dir}/t", datetime(2024, 3, 1, 12)
    doc = '{"name":"%s","sys":{"country":"XX"},"main":{"temp":%s,"feels_like":20,"humidity":50,"pressure":1000},"wind":{"speed":2},"weather":[{"main":"Clear","description":"clear sky"}]}'
    requests = spark.createDataFrame([("oslo",), ("OSLO",), ("Rome",), ("Nowhere",), ("Broken",)], "city string")
    docs = spark.createDataFrame(
        [("Oslo", doc % ("Oslo", 10)), ("Oslo", doc % ("Oslo", 10)), ("rome", doc % ("Rome", 25)), ("Broken", "{"), ("Unasked", doc % ("Unasked", 1))],
        "city string, doc string",
    )
    got, counts = R.live_fetch(spark, requests, docs, table, now)
    rows = {r.requested_city: (r.status, r.city, r.temperature_c) for r in got.collect()}
    assert rows == {
        "oslo": ("fetched", "Oslo", 10.0), "OSLO": ("fetched", "Oslo", 10.0), "Rome": ("fetched", "Rome", 25.0),
        "Nowhere": ("missing", None, None), "Broken": ("missing", None, None)}
    assert counts == {"inserted": 2, "skipped": 0, "failed": 0}
    again, counts = R.live_fetch(spark, requests, docs, table, now + timedelta(seconds=30))
    assert counts["inserted"] == 0
    assert {r.requested_city for r in again.where("status = 'fresh'").collect()} == {"oslo", "OSLO", "Rome"}
    later, counts = R.live_fetch(spark, requests, docs, table, now + timedelta(seconds=91))
    assert counts["inserted"] == 2 and L.read_table(spark, table).count() == 4
    assert {r.status for r in later.collect()} == {"fetched", "missing"}


def newest(spark, landing):
    """Rows of the landing folder as the stream gives them, with a fixed insertion time."""
    return S.landing_stream(spark, landing).withColumn("inserted_at", F.col("extracted_at"))


def test_latest_table_equals_batch_after_replays(spark, tmp_dir):
    landing, path = f"{tmp_dir}/landing", f"{tmp_dir}/latest"
    for where in (LATE, EARLY):  # the older half comes second
        land(spark, landing, where)
        S.start_latest_table(spark, newest(spark, landing), path, checkpoint_location=f"{tmp_dir}/ck", parts=4).awaitTermination()
    S.start_latest_table(spark, newest(spark, landing), path, checkpoint_location=f"{tmp_dir}/ck2", parts=4).awaitTermination()
    q = S.start_memory_sink(spark, newest(spark, landing), "all_rows", checkpoint_location=f"{tmp_dir}/ck3")
    q.awaitTermination()
    expected = activity.latest_per_city(spark.table("all_rows"))
    got = S.read_latest(spark, path).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    # old generations are gone: one a part
    assert all(len(os.listdir(p)) == 1 for p in glob.glob(f"{path}/part=*"))
    # streaming state gives whole rows too
    S.start_memory_sink(spark, S.latest_per_city(newest(spark, landing)), "latest_state", mode="complete", checkpoint_location=f"{tmp_dir}/ck4").awaitTermination()
    assert sorted(map(str, spark.table("latest_state").select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_latest_table_survives_a_stop_between_write_and_clean_up(spark, tmp_dir):
    path = f"{tmp_dir}/latest"
    row = lambda city, t, n: (city, datetime(2024, 1, 1, t), datetime(2024, 1, 1, t), n)
    schema = "city string, recorded_at timestamp_ntz, inserted_at timestamp_ntz, obs_id bigint"
    S.merge_latest(spark, spark.createDataFrame([row("a", 1, 1), row("b", 1, 2)], schema), path, parts=1)
    # an older generation that was not cleaned up, with rows that are no longer the newest
    old = spark.createDataFrame([row("a", 0, 9)], schema).withColumns({"part": F.lit(0), "generation": F.lit("gleft")})
    old.write.mode("append").partitionBy("part", "generation").parquet(path)
    assert {(r.city, r.obs_id) for r in S.read_latest(spark, path).collect()} == {("a", 1), ("b", 2)}
    S.merge_latest(spark, spark.createDataFrame([row("b", 2, 3), (None, None, None, 4)], schema), path, parts=1)
    assert {(r.city, r.obs_id) for r in S.read_latest(spark, path).collect()} == {("a", 1), ("b", 3)}
    S.merge_latest(spark, spark.createDataFrame([], schema), path, parts=1)
    assert S.read_latest(spark, path).count() == 2


def same(a, b):
    def near(x, y):
        if isinstance(x, float) and isinstance(y, float):
            return math.isclose(x, y, abs_tol=0.0100001)  # a rounding tie may fall either way
        return x == y
    return len(a) == len(b) and all(near(x, y) for p, q in zip(a, b) for x, y in zip(p, q))


def test_seven_reports_from_one_scan(spark, tmp_dir):
    st = V.stored(spark, SF_SMALL)
    st.write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    plan = reports.rollup(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    bundle = reports.generate_all_reports(df, f"{tmp_dir}/rollup")
    assert list(bundle) == list(reports.REPORTS)
    halves = reports.rollup(df.where("obs_id % 2 = 0")).unionByName(reports.rollup(df.where("obs_id % 2 = 1")))
    merged = reports.reports_from_rollup(reports.merge_rollups(halves))
    for name, fn in reports.REPORTS.items():
        want = fn(df)
        order = [c for c in ("city", "date", "comfort_level") if c in want.columns]
        rows = lambda f: [tuple(r) for r in f.orderBy(*order).collect()]
        assert bundle[name].columns == want.columns and same(rows(bundle[name]), rows(want)), name
        assert rows(merged[name]) == rows(bundle[name]), name
    meta = reports.metadata_from_rollup(spark.read.parquet(f"{tmp_dir}/rollup")).collect()
    assert meta == reports.report_metadata(df).collect()
    assert reports.generate_all_reports(df.where("false"), f"{tmp_dir}/rollup_empty") == {}


def test_rollup_sums_are_exact_and_tolerate_odd_values(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), "Clear", None, x, None, None, None, None) for x in (0.1, 0.2, 0.3, float("inf"), None)]
        + [(None, None, None, None, 1.0, 1.0, 1, 1.0, 1.0)],
        "city string, recorded_at timestamp_ntz, weather_condition string, comfort_level string, temperature_c double, "
        "feels_like_c double, humidity_pct int, wind_speed_mps double, heat_index_c double",
    )
    cells = {r.city: r for r in reports.rollup(df).collect()}
    assert float(cells["a"].temperature_c__sum) == 0.6 and cells["a"].temperature_c__n == 3 and cells["a"].rows == 5
    got = reports.reports_from_rollup(reports.rollup(df))
    assert [r.city for r in got["City Temperature Summary"].collect()] == ["a"]
    assert got["Comfort Distribution"].count() == 0


def test_issue_samples_are_the_smallest_ids_and_limited_before_the_shuffle(spark):
    v = V.validation(spark, SF_SMALL)
    for r in v.issues(3).collect():
        rule = v.rules[r.rule_order]
        ids = sorted(x.obs_id for x in v.flagged.where(f"f_{rule.rule_id}").select("obs_id").collect())
        assert r.sample_ids == ids[:3] and len(r.sample_values) == len(r.sample_ids)
    plan = v.samples()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    empty = quality.validate(V.transformed(spark, SF_SMALL).where("false"))
    assert empty.issues().count() == 0 and empty.samples().count() == 0 and empty.warnings.count() == 0


@pytest.mark.parametrize("rows_per_file, at_least", [(10, 20), (10_000, 1)])
def test_a_dates_files_follow_its_size(spark, tmp_dir, rows_per_file, at_least):
    base = V.transformed(spark, SF_SMALL).where("obs_id < 600").withColumn("city", F.concat(F.lit("c"), F.col("obs_id").cast("string")))
    hot = base.withColumn("recorded_at", F.when(F.col("obs_id") % 3 > 0, F.lit(T_HOT)).otherwise(F.col("recorded_at")))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = L.load(spark, hot, f"{tmp_dir}/t", run_ts=T_HOT, rows_per_file=rows_per_file)
    finally:
        spark.conf.set(conf, "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = {os.path.basename(d): len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{tmp_dir}/t/date=*")}
    assert sum(got.values()) == hot.count() and got["inserted"] == L.read_table(spark, f"{tmp_dir}/t").count()
    assert files["date=2023-12-25"] >= at_least
    if at_least == 1:
        assert set(files.values()) == {1}


T_HOT = datetime(2023, 12, 25, 1)


def test_ordered_export_concatenates_to_the_whole_table(spark, tmp_dir):
    st = V.stored(spark, SF_SMALL)
    st.write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        R.export_observations(df, f"{tmp_dir}/x")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(glob.glob(f"{tmp_dir}/x/rows/part-*"))
    assert len(parts) > 1
    header = open(glob.glob(f"{tmp_dir}/x/header/part-*")[0]).read().strip().split(",")
    lines = [line for p in parts for line in open(p).read().splitlines()]
    pos = header.index("obs_id")
    assert header == df.columns
    assert [int(line.split(",")[pos]) for line in lines] == [r.obs_id for r in activity.fetch_all(df).collect()]


def test_stored_layout_is_what_the_load_writes(spark):
    declared = {f.name: f.dataType for f in T._parse_datatype_string(transform.STORED_LAYOUT).fields}
    made = {f.name: f.dataType for f in V.stored(spark, SF_SMALL).schema.fields}
    assert declared == made
