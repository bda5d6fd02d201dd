"""Plan-shape checks for hot keys: a key holding a third of all rows must not land in one
task whole (AQE splits the skewed join partition; aggregates combine map-side)."""

from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wxspark.functions import expr as X
from wxspark.operators import activity, quality

T0 = datetime(2024, 1, 1)


def skewed(spark, n=30000):
    # one (city, hour) key holds a third of the rows; the rest are spread
    df = spark.range(n).select(
        F.col("id").alias("obs_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string"))).alias("city"),
        F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(F.lit(T0) + F.make_dt_interval(F.lit(0), (F.col("id") % 50).cast("int"))).cast("timestamp_ntz").alias("recorded_at"),
        F.lit(20.0).alias("temperature_c"),
        F.lit(50).alias("humidity_pct"),
        F.lit(1000).alias("pressure_hpa"),
        F.lit("Rain").alias("weather_condition"),
    )
    return df.repartition(16)


def test_hot_duplicate_key_is_split_by_aqe(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        flagged = quality.mark_duplicates(skewed(spark))
        rows = flagged.collect()  # same QueryExecution -> its AQE plan becomes final
        n_dup = sum(r["_is_duplicate"] for r in rows)
        keys = {("HOT", 0) if i % 3 == 0 else (i % 997, i % 50) for i in range(30000)}
        assert n_dup == 30000 - len(keys)
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_latest_per_city_has_no_window(spark):
    df = skewed(spark).withColumn("inserted_at", F.col("recorded_at")).withColumn("id", F.col("obs_id").cast("string"))
    out = activity.latest_per_city(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert out.where("city = 'HOT'").count() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ -'3é", max_size=12), min_size=1, max_size=8))
def test_title_case_equals_python(spark, texts):
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(X.title_case("x")).collect()]
    assert got == [t.title() for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-100, max_value=100, allow_nan=False)), min_size=1, max_size=20))
def test_comfort_is_total(spark, temps):
    df = spark.createDataFrame([(t,) for t in temps], "x double")
    got = [r[0] for r in df.select(X.comfort_level("x", "batch")).collect()]
    assert all(g in ("Cold", "Cool", "Comfortable", "Warm", "Hot", "Unknown") for g in got)
    assert [g == "Unknown" for g in got] == [t is None for t in temps]
