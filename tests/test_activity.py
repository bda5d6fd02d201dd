"""Dashboard/activity operators on hand-written and derived inputs (FIXTURES.md C)."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from wxspark.operators import activity, reports
from wxspark.plans import views as V

SCHEMA = "obs_id long, city string, weather_condition string, temperature_c double, recorded_at timestamp_ntz, inserted_at timestamp_ntz, id string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_hourly_activity_zero_fills_gaps(spark):
    # one user's events leave empty hours; the spine must fill them with 0
    o = V.obs(spark, SF_MID)
    user = spark.read.parquet(f"{SF_MID}/events.parquet").where("user_id = 7").select(F.col("event_id").alias("obs_id"))
    one = o.join(user, "obs_id", "left_semi")
    got = activity.hourly_activity(one).collect()
    hours = [r.Hour for r in got]
    assert hours == sorted(hours) and all((b - a).total_seconds() == 3600 for a, b in zip(hours, hours[1:]))
    assert any(r.Searches == 0 for r in got)
    assert sum(r.Searches for r in got) == one.count()


def test_hourly_activity_over_a_million_hours(spark):
    """The spine of a long range is no single row or task, and the counts' exchange is reused."""
    t1, t2 = datetime(1910, 1, 1, 5, 30), datetime(2024, 3, 1, 7)
    rows = [(1, "Pune", "Rain", 20.0, t1, t1, "a"), (2, "Pune", "Rain", 21.0, t2, t2, "b"), (3, "Pune", "Rain", 21.0, t2, t2, "c")]
    got = activity.hourly_activity(frame(spark, rows))
    hours = int((t2.replace(minute=0) - t1.replace(minute=0)).total_seconds() // 3600) + 1
    assert hours > 10**6 and got.count() == hours
    assert got.agg(F.sum("Searches")).first()[0] == 3 and [r.Searches for r in got.tail(2)] == [0, 2]
    assert got.rdd.getNumPartitions() > 1
    assert activity.hourly_activity(frame(spark, [])).count() == 0


def test_common_condition_tie_goes_to_alphabetical_first(spark):
    t = datetime(2024, 1, 1)
    rows = [(i, "Pune", c, 20.0, t, t, str(i)) for i, c in enumerate(["Rain", "Clear", "Rain", "Clear", "Haze"])]
    got = reports.common_weather_conditions(frame(spark, rows)).first()
    assert (got.most_common_condition, got.occurrences) == ("Clear", 2)


def test_fetch_latest_keeps_ties_and_window_form_picks_one(spark):
    t1, t2 = datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)
    rows = [(1, "Pune", "Rain", 20.0, t1, t1, "a"), (2, "Pune", "Rain", 21.0, t2, t2, "b"), (3, "Pune", "Haze", 22.0, t2, t2, "c")]
    df = frame(spark, rows)
    assert sorted(r.obs_id for r in activity.fetch_latest(df).collect()) == [2, 3]
    assert [r.obs_id for r in activity.latest_per_city(df).collect()] == [2]


def test_recent_searches_top_k_and_names(spark):
    df = V.stored(spark, SF_MID)
    got = activity.recent_searches(df)
    assert got.columns == ["Search Time", "City", "Temp (°C)", "Humidity (%)", "Pressure (hPa)", "Condition"]
    assert got.count() == 20
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_fresh_lookup_window(spark):
    t = datetime(2024, 1, 1, 12, 0, 0)
    rows = [(1, "Kolkata", "Rain", 30.0, t, datetime(2024, 1, 1, 11, 59, 30), "a"), (2, "Delhi", "Rain", 30.0, t, datetime(2024, 1, 1, 11, 58, 0), "b")]
    df = frame(spark, rows)
    assert activity.fresh_city_lookup(df, "KOLKATA", F.lit(t)).count() == 1
    assert activity.fresh_city_lookup(df, "delhi", F.lit(t)).count() == 0
    req = spark.createDataFrame([("kolkata",), ("Delhi",), ("Paris",)], "city string")
    got = {r.requested_city: r.status for r in activity.fresh_city_bulk(req, df, F.lit(t)).collect()}
    assert got == {"kolkata": "fresh", "Delhi": "stale", "Paris": "stale"}


def test_cached_record_falsy_defaults(spark):
    t = datetime(2024, 1, 1)
    df = V.stored(spark, SF_MID).limit(1).withColumns(
        {"visibility_m": F.lit(0), "temp_min_c": F.lit(0.0), "temperature_c": F.lit(-3.7), "cloudiness_pct": F.lit(None).cast("int")}
    )
    r = activity.cached_record(df).first()
    assert (r.visibility, r.temp_min, r.temperature, r.clouds, r.timezone_offset) == (10000, -3, -3, 0, 0)
    assert t is not None


def test_report_bundle(spark):
    bundle = reports.generate_all_reports(V.stored(spark, SF_MID))
    assert list(bundle) == list(reports.REPORTS)
    assert reports.generate_all_reports(V.stored(spark, SF_MID).where("false")) == {}
