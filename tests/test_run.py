"""End-to-end batch run over landing files: extract -> validate -> load -> report."""

import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wxspark.operators import load as L
from wxspark.operators import reports
from wxspark.plans import run as R
from wxspark.plans import views as V
from wxspark.sources import raw_json, sinks


def test_run_batch_end_to_end_and_rerun_is_idempotent(spark, tmp_dir):
    landing, table, out = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/out"
    o = V.obs(spark, SF_SMALL)
    sinks.write_landing(o.select(raw_json.observation_to_raw(o).alias("doc"), F.col("inserted_at").alias("ingest_ts")), landing)
    os.makedirs(os.path.join(landing, "ingest_date=2024-02-01"))
    with open(os.path.join(landing, "ingest_date=2024-02-01", "broken.json"), "w") as f:
        f.write('{"name": "Kolkata", \n')
    ts = datetime(2024, 2, 1, 0, 0)
    res = R.run_batch(spark, landing, table, out, run_ts=ts)
    assert res.status == "SUCCESS", res
    assert res.stages["transform"]["records_out"] == 1000
    assert res.stages["validate"]["clean_record_count"] > 0
    first_load = res.stages["load"]
    assert first_load["inserted"] == res.stages["validate"]["clean_record_count"]
    assert len(res.outputs["reports"]) == 7
    assert spark.read.parquet(f"{out}/rejects").count() == 1
    # the CSV is copied from the report's single parquet file: same rows, same order
    csv_dir = f"{out}/reports/run_id=20240201_000000/city_temperature_summary/csv"
    part = [p for p in os.listdir(csv_dir) if p.startswith("part-") and p.endswith(".csv")]
    assert len(part) == 1
    csv_cities = [line.split(",")[0].strip('"') for line in open(os.path.join(csv_dir, part[0])).read().splitlines()[1:]]
    expected = [r.city for r in reports.city_temperature_summary(L.read_table(spark, table)).collect()]
    assert csv_cities == expected
    summary_dir = f"{out}/validation_summary/run_id=20240201_000000"
    summary = json.loads(open([os.path.join(summary_dir, p) for p in os.listdir(summary_dir) if p.endswith(".json")][0]).readline())
    assert summary["original_record_count"] == 1000
    issues = spark.read.json(f"{out}/validation_issues")
    assert issues.count() == summary["total_issues"]
    res2 = R.run_batch(spark, landing, table, out, run_ts=datetime(2024, 2, 1, 1, 0))
    assert res2.stages["load"]["inserted"] == 0
    assert L.read_table(spark, table).count() == first_load["inserted"]
    assert res.metrics_frame(spark).count() > 0


def test_run_batch_empty_landing_fails(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(os.path.join(landing, "empty.json"), "w") as f:
        f.write("")
    res = R.run_batch(spark, landing, f"{tmp_dir}/t", f"{tmp_dir}/o", run_ts=datetime(2024, 2, 1))
    assert res.status == "FAILED"


def test_search_analytics_bundle(spark):
    got = R.search_analytics(V.stored(spark, SF_SMALL))
    assert set(got) == {"recent_searches", "city_search_counts", "top5_cities", "activity_over_time"}
    assert got["top5_cities"].count() == 5


def test_load_failure_falls_back_to_clean_rows(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    o = V.obs(spark, SF_SMALL)
    sinks.write_landing(o.select(raw_json.observation_to_raw(o).alias("doc"), F.col("inserted_at").alias("ingest_ts")), landing)
    blocked = f"{tmp_dir}/not_a_table"
    with open(blocked, "w") as f:  # a plain file where the table folder should be
        f.write("x")
    res = R.run_batch(spark, landing, blocked, f"{tmp_dir}/out", run_ts=datetime(2024, 2, 1))
    assert res.status == "SUCCESS" and "error" in res.stages["load"]
    assert len(res.outputs["reports"]) == 7


def test_cluster_session_without_checkpoint_dir_is_an_error():
    # A driver-local folder would be invisible to executors: only local mode may fall back.
    import pytest
    from types import SimpleNamespace

    from wxspark.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(master="spark://cluster:7077", getConf=lambda: conf)
    fake = SimpleNamespace(conf=conf, sparkContext=sc)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)
