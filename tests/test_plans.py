"""Plan-shape checks: expensive per-row work (JSON parsing) is evaluated once per row, and
the shared view chain is built once per session and input folder."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wxspark.plans import views as V


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["city_temperature_summary", "dq_clean", "dq_summary", "kpi_row"])
def test_clean_filter_does_not_parse_props_twice(spark, name):
    # The clean filter is one predicate over all critical flags, so no per-column
    # conjunct is pushed below the duplicate join to parse the event JSON a second time.
    plan = optimized(E.queries()[name](spark, SF_SMALL))
    assert plan.count("get_json_object") == 1


@pytest.mark.parametrize("name", ["raw_json_parse", "raw_json_rejects", "live_profile_projection"])
def test_document_is_parsed_once(spark, name):
    # The reject split filters on parsed fields; the parse must not be copied into it.
    plan = optimized(E.queries()[name](spark, SF_SMALL))
    assert plan.count("from_json(") == 1


def test_views_are_built_once_per_session_and_folder(spark):
    assert V.obs(spark, SF_SMALL) is V.obs(spark, SF_SMALL)
    assert V.clean(spark, SF_SMALL) is V.clean(spark, SF_SMALL)
    first = V.stored(spark, SF_SMALL)
    V.refresh()
    again = V.stored(spark, SF_SMALL)
    assert again is not first
    assert sorted(again.columns) == sorted(first.columns)


def test_most_common_condition_needs_no_window(spark):
    # min(struct(-occurrences, condition)) per city: an aggregate, never a city window
    plan = optimized(E.queries()["common_weather_conditions"](spark, SF_SMALL))
    assert "Window" not in plan


def test_run_driver_stages_landing_json_once(spark, tmp_dir):
    from pyspark.sql import functions as F

    from wxspark.plans import run as R
    from wxspark.sources import raw_json, sinks

    landing, stage = f"{tmp_dir}/landing", f"{tmp_dir}/stage"
    o = V.obs(spark, SF_SMALL)
    sinks.write_landing(o.select(raw_json.observation_to_raw(o).alias("doc"), F.col("inserted_at").alias("ingest_ts")), landing)
    good, bad = R.ingest(spark, landing, stage_path=stage)
    # both outputs read the parquet stage, not the JSON files
    for df in (good, bad):
        assert "JSON" not in df._jdf.queryExecution().executedPlan().toString()
    assert good.count() + bad.count() == spark.read.parquet(stage).count() == 1000
