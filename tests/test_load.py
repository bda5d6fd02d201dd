"""Keyed load: the load smoke block, idempotence, batch-split property, pruning."""

from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wxspark.operators import load as L
from wxspark.operators import transform
from wxspark.plans import views as V

T = datetime(2024, 9, 15, 14, 30)


def row_frame(spark):
    df = spark.createDataFrame(
        [("Kolkata", "IN", 30.0, 80, 1005, "Clouds", T)],
        "city string, country string, temperature_c double, humidity_pct int, pressure_hpa int, weather_condition string, recorded_at timestamp_ntz",
    )
    return df.withColumn("obs_id", F.lit(1).cast("bigint"))


def full_columns(df):
    for c, t in [("feels_like_c", "double"), ("temp_min_c", "double"), ("temp_max_c", "double"), ("wind_speed_mps", "double"),
                 ("wind_direction_deg", "int"), ("weather_description", "string"), ("visibility_m", "int"), ("cloudiness_pct", "int"),
                 ("extracted_at", "timestamp_ntz"), ("heat_index_c", "double"), ("comfort_level", "string")]:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def test_load_smoke_block(spark, tmp_dir):
    path = f"{tmp_dir}/weather"
    df = full_columns(row_frame(spark))
    assert L.load(spark, df, path, run_ts=T) == {"inserted": 1, "skipped": 0, "failed": 0}
    assert L.load(spark, df, path, run_ts=T) == {"inserted": 0, "skipped": 1, "failed": 0}
    stored = L.read_table(spark, path).collect()
    assert len(stored) == 1 and stored[0].feels_like_c is None and stored[0].inserted_at == T


def test_null_keys_fail(spark, tmp_dir):
    df = full_columns(row_frame(spark)).withColumn("city", F.lit(None).cast("string"))
    assert L.load(spark, df, f"{tmp_dir}/w", run_ts=T) == {"inserted": 0, "skipped": 0, "failed": 1}


def test_load_twice_equals_once_and_first_wins(spark, tmp_dir):
    path = f"{tmp_dir}/weather"
    batch = V.transformed(spark, SF_SMALL)
    s1 = L.load(spark, batch, path)
    first = sorted(tuple(r) for r in L.read_table(spark, path).select("obs_id", "city", "recorded_at").collect())
    s2 = L.load(spark, batch, path)
    again = sorted(tuple(r) for r in L.read_table(spark, path).select("obs_id", "city", "recorded_at").collect())
    assert first == again and s2["inserted"] == 0
    assert s1["inserted"] + s1["skipped"] + s1["failed"] == 1000
    # first row (smallest obs_id) of every key is the one stored
    expected = batch.where("city IS NOT NULL AND recorded_at IS NOT NULL").groupBy("city", "recorded_at").agg(F.min("obs_id").alias("m"))
    assert {r.m for r in expected.collect()} == {r[0] for r in first}


@settings(max_examples=3, deadline=None)
@given(st.integers(min_value=1, max_value=999))
def test_ordered_batch_split_gives_same_table(spark, cut):
    batch = V.transformed(spark, SF_SMALL)
    whole = transform.to_stored(batch)
    once = {r.obs_id for r in L.insert_if_absent(whole, None).select("obs_id").collect()}
    a = transform.to_stored(batch.where(F.col("obs_id") < cut))
    b = transform.to_stored(batch.where(F.col("obs_id") >= cut))
    ins_a = L.insert_if_absent(a, None)
    ins_b = L.insert_if_absent(b, ins_a)
    split = {r.obs_id for r in ins_a.unionByName(ins_b).select("obs_id").collect()}
    assert split == once


def test_stored_side_is_pruned_to_batch_dates(spark, tmp_dir):
    path = f"{tmp_dir}/weather"
    L.load(spark, V.transformed(spark, SF_SMALL), path)
    batch = transform.to_stored(V.transformed(spark, SF_SMALL).where("recorded_at < '2024-01-03'"))
    plan = L.classify(batch, L.read_table(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert "ReadSchema: struct<city:string,recorded_at:timestamp_ntz>" in plan


def test_create_table_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/weather"
    schema = transform.to_stored(V.transformed(spark, SF_SMALL)).schema
    L.create_table(spark, path, schema)
    assert L.table_exists(spark, path) and L.read_table(spark, path, schema).count() == 0
    L.load(spark, V.transformed(spark, SF_SMALL), path)
    n = L.read_table(spark, path).count()
    L.create_table(spark, path, schema)  # second call keeps the data
    assert L.read_table(spark, path).count() == n > 0
