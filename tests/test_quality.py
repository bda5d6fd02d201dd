"""Data-quality engine: the validate smoke block, golden counts, set properties."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wxspark.operators import quality, transform
from wxspark.plans import views as V

SCHEMA = "obs_id long, city string, temperature_c double, humidity_pct int, pressure_hpa int, weather_condition string, recorded_at timestamp_ntz"
T = datetime(2024, 9, 15, 14, 30)


def block(spark):
    rows = [
        (0, "Kolkata", 34.2, 78, 1005, "Clouds", T),
        (1, "Delhi", 38.1, 55, 1010, "Clear", T),
        (2, "BadCity", 999.9, 60, 1008, "Haze", T),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_validate_smoke_block(spark):
    v = quality.validate(block(spark))
    s = v.summary().first().asDict()
    assert s == {
        "original_record_count": 3,
        "clean_record_count": 2,
        "dropped_record_count": 1,
        "pass_rate_pct": 66.7,
        "total_issues": 1,
        "critical_issues": 1,
        "warning_issues": 0,
        "status": "PARTIAL",
    }
    issues = v.issues().collect()
    assert len(issues) == 1 and issues[0]["check"] == "RANGE_VIOLATION" and issues[0]["max_value"] == 999.9
    assert sorted(r.city for r in v.clean.collect()) == ["Delhi", "Kolkata"]
    assert v.null_counts().count() == 0


def test_empty_input_is_skipped(spark):
    v = quality.validate(spark.createDataFrame([], SCHEMA))
    s = v.summary().first()
    assert s["status"] == "SKIPPED" and s["pass_rate_pct"] == 0.0 and s["original_record_count"] == 0


def test_passed_when_nothing_dropped(spark):
    v = quality.validate(block(spark).where("obs_id < 2"))
    assert v.summary().first()["status"] == "PASSED"


def test_first_duplicate_invalid_drops_both(spark):
    rows = [(0, "Pune", 999.9, 50, 1000, "Rain", T), (1, "Pune", 20.0, 50, 1000, "Rain", T), (2, None, 20.0, 50, 1000, "Rain", T), (3, None, 21.0, 50, 1000, "Rain", T)]
    v = quality.validate(spark.createDataFrame(rows, SCHEMA))
    f = {r.obs_id: r for r in v.flagged.collect()}
    assert f[0].f_range_temperature_c and not f[0].f_duplicate
    assert f[1].f_duplicate  # second of the pair goes although the first is invalid too
    assert f[3].f_duplicate and not f[2].f_duplicate  # NULL keys compare equal
    assert v.clean.count() == 0


def test_short_city_warning_only(spark):
    rows = [(0, "X", 20.0, 50, 1000, "Rain", T), (1, "", 20.0, 50, 1000, "Rain", datetime(2024, 1, 1))]
    v = quality.validate(spark.createDataFrame(rows, SCHEMA))
    assert v.clean.count() == 2
    s = v.summary().first()
    assert s.warning_issues == 1 and s.critical_issues == 0 and s.status == "PASSED"


def test_golden_counts_sf0001(spark):
    v = V.validation(spark, SF_SMALL)
    issues = {(r["check"], r["column"]): r["affected_rows"] for r in v.issues().collect()}
    assert issues[("NULL_VALUE", "city")] == 11
    assert issues[("NULL_VALUE", "temperature_c")] == 20
    assert issues[("NULL_VALUE", "weather_condition")] == 10
    assert issues[("RANGE_VIOLATION", "temperature_c")] == 16
    assert issues[("RANGE_VIOLATION", "humidity_pct")] == 15
    assert issues[("RANGE_VIOLATION", "pressure_hpa")] == 13
    assert issues[("DUPLICATE_RECORD", "city,recorded_at")] == 78
    assert issues[("SUSPICIOUS_CITY_NAME", "city")] == 11
    assert v.summary().first()["clean_record_count"] == 859


def test_clean_and_quarantine_partition_the_input(spark):
    v = V.validation(spark, SF_SMALL)
    ids = lambda df: {r.obs_id for r in df.select("obs_id").collect()}
    clean, quarantine, all_ids = ids(v.clean), ids(v.quarantine), ids(V.obs(spark, SF_SMALL))
    assert clean | quarantine == all_ids and not clean & quarantine


def test_duplicate_detection_is_one_shuffle_without_window(spark):
    plan = V.validation(spark, SF_SMALL).flagged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_custom_rule_extends_engine(spark):
    rules = quality.default_rules() + [quality.range_rule("pressure_hpa", 900, 1100, critical=True)]
    rules[-1] = quality.Rule(**{**rules[-1].__dict__, "rule_id": "pressure_strict"})
    v = quality.validate(block(spark).withColumn("pressure_hpa", F.lit(850)), rules)
    assert v.clean.count() == 0


def test_derived_columns_before_validation(spark):
    df = transform.add_derived(block(spark))
    got = {r.city: (r.heat_index_c, r.comfort_level) for r in df.collect()}
    assert got["Kolkata"] == (51.9, "Warm")
