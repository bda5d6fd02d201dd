"""Dashboard and search-activity queries over the stored observation table.

All are aggregates or top-k over the table; nothing is pulled to the driver. Per-city
"latest" uses a ``max(struct(...))`` aggregate (algebraic, so a city holding a third of
the rows costs one partial row per task) instead of a window partitioned by city.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.functions import expr as X

FRESHNESS = timedelta(seconds=60)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Display names of the "recent searches" table, in order.
RECENT_COLUMNS = (
    ("inserted_at", "Search Time"),
    ("city", "City"),
    ("temperature_c", "Temp (°C)"),
    ("humidity_pct", "Humidity (%)"),
    ("pressure_hpa", "Pressure (hPa)"),
    ("weather_condition", "Condition"),
)
RECENT_LIMIT = 20
TOP_CITIES = 5


def newest_first() -> list[Column]:
    """Newest reading first; a total order, as the id breaks ties."""
    return [F.desc_nulls_last("recorded_at"), F.desc_nulls_last("inserted_at"), F.col("obs_id")]


def fetch_all(df: DataFrame) -> DataFrame:
    """Whole table, newest reading first (total order: id breaks ties)."""
    return df.orderBy(*newest_first())


def recent_searches(df: DataFrame, limit: int = RECENT_LIMIT) -> DataFrame:
    """Top-k by time (TakeOrderedAndProject: each task keeps k rows, the driver merges k*tasks)."""
    present = set(df.columns)
    ordered = df.orderBy(F.desc_nulls_last("recorded_at"), F.desc_nulls_last("inserted_at"), "obs_id").limit(limit)
    return ordered.select(*[F.col(c).alias(alias) for c, alias in RECENT_COLUMNS if c in present])


def city_search_counts(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("Search Count"))
        .select(F.col("city").alias("City"), "Search Count")
        .orderBy(F.desc("Search Count"), "City")
    )


def top_cities(df: DataFrame, k: int = TOP_CITIES) -> DataFrame:
    return city_search_counts(df).limit(k)


def hourly_activity(df: DataFrame, time_col: str = "inserted_at") -> DataFrame:
    """Readings per hour with zero-filled gaps between the first and last hour.

    The spine is dealt out: one row per day of the range, each exploded into its hours by
    the task that holds it, then joined to the hourly counts. First and last hour come from
    these counts too, whose exchange is made once, so the input is read once.
    """
    hour = X.trunc_hour_ntz(time_col)
    counts = (
        df.where(F.col(time_col).isNotNull())
        .groupBy(hour.alias("Hour"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ends = counts.agg(F.min("Hour").alias("_first"), F.max("Hour").alias("_last"))
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
    days = ends.select("*", F.explode(F.sequence(day("_first"), day("_last"), F.expr("INTERVAL 1 DAY"))).alias("_day")).repartition("_day")
    hours = F.explode(F.sequence(F.col("_day"), F.col("_day") + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR")))
    spine = days.select("_first", "_last", hours.alias("Hour")).filter("Hour between _first and _last").select("Hour")
    return spine.join(counts, "Hour", "left").select("Hour", F.coalesce("_n", F.lit(0)).cast("bigint").alias("Searches")).orderBy("Hour")


def hourly_window_counts(df: DataFrame, time_col: str = "inserted_at") -> DataFrame:
    """Batch twin of the streaming hourly count: tumbling 1-hour windows, no zero fill."""
    return (
        df.where(F.col(time_col).isNotNull())
        .groupBy(F.window(time_col, "1 hour"))
        .agg(F.count(F.lit(1)).alias("searches"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "searches",
        )
    )


def kpi_row(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        X.round_half_even(F.avg("temperature_c"), 1).alias("avg_temp_c"),
        X.round_half_even(F.avg("humidity_pct"), 1).alias("avg_humidity_pct"),
        X.round_half_even(F.avg("pressure_hpa"), 1).alias("avg_pressure_hpa"),
        F.count_distinct("city").alias("cities"),
    )


def city_mean_temperature(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.avg("temperature_c").alias("mean_temperature_c"))
        .orderBy(F.desc_nulls_last("mean_temperature_c"), "city")
    )


def condition_distribution(df: DataFrame) -> DataFrame:
    return (
        df.select(F.coalesce("weather_condition", F.lit("Unknown")).alias("weather_condition"))
        .groupBy("weather_condition")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "weather_condition")
    )


def series(df: DataFrame, value_col: str, time_col: str = "recorded_at") -> DataFrame:
    """(time, value) ordered by time, NULL times last (total order via obs_id)."""
    return df.select(time_col, value_col, "obs_id").orderBy(F.asc_nulls_last(time_col), "obs_id").drop("obs_id")


def fetch_latest(df: DataFrame) -> DataFrame:
    """Latest reading(s) per city as a self equi-join with the grouped max; ties all kept."""
    latest = (
        df.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.max("recorded_at").alias("_max_ts"))
        .withColumnRenamed("city", "_city")
    )
    joined = df.join(latest, (df.city == latest._city) & (df.recorded_at == latest._max_ts), "inner")
    return joined.drop("_city", "_max_ts").orderBy("city", "obs_id")


def latest_per_city(df: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Exactly one latest row per city: greatest (recorded_at, inserted_at, -obs_id).

    A ``max`` over a struct is an algebraic aggregate (partial per task), so a hot city
    never lands whole in one task, unlike ``row_number`` over a city window.
    """
    order = order or [F.col("recorded_at"), F.col("inserted_at"), -F.col("obs_id")]
    cols = [c for c in df.columns]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*cols).alias("row"))
    return (
        df.where(F.col("city").isNotNull())
        .groupBy(F.col("city").alias("_city"))
        .agg(F.max(packed).alias("_best"))
        .select("_best.row.*")
    )


def fresh_rows(df: DataFrame, as_of: Column, window: timedelta = FRESHNESS) -> DataFrame:
    """Rows inserted within ``window`` before ``as_of`` (inclusive)."""
    seconds = int(window.total_seconds())
    return df.where(F.col("inserted_at") >= as_of - F.expr(f"INTERVAL {seconds} SECONDS"))


def fresh_city_lookup(df: DataFrame, city: str, as_of: Column, window: timedelta = FRESHNESS) -> DataFrame:
    """Freshest row of one city (case-insensitive) inserted within ``window`` of ``as_of``."""
    hit = fresh_rows(df.where(F.lower("city") == F.lower(F.lit(city))), as_of, window)
    return hit.orderBy(F.desc("inserted_at"), "obs_id").limit(1)


def fresh_city_bulk(requests: DataFrame, df: DataFrame, as_of: Column, window: timedelta = FRESHNESS) -> DataFrame:
    """Split requested cities into ``fresh`` (a row within the window) and ``stale``.

    ``requests`` has a ``city`` column. Fresh candidates are reduced to one row per
    lower-cased city by an algebraic max before the join, so the join is one row per city.
    """
    fresh = fresh_rows(df, as_of, window).withColumn("_key", F.lower("city"))
    best = fresh.groupBy("_key").agg(
        F.max(F.struct(F.col("inserted_at"), -F.col("obs_id"), F.col("id"))).alias("_b")
    )
    req = requests.select(F.col("city").alias("requested_city"), F.lower("city").alias("_key")).distinct()
    return req.join(best, "_key", "left").select(
        "requested_city",
        F.when(F.col("_b").isNull(), "stale").otherwise("fresh").alias("status"),
        F.col("_b.id").alias("id"),
        F.col("_b.inserted_at").alias("inserted_at"),
    )


def cached_record(df: DataFrame) -> DataFrame:
    """Stored row -> display record: ``int()`` truncation and "falsy -> default"."""
    def i(c: Column) -> Column:
        return c.cast("double").cast("int")

    temp = F.col("temperature_c")
    return df.select(
        "id",
        "city",
        F.col("country"),
        i(X.falsy_default(temp, 0)).alias("temperature"),
        i(X.falsy_default("feels_like_c", 0)).alias("feels_like"),
        i(X.falsy_default("humidity_pct", 0)).alias("humidity"),
        i(X.falsy_default("pressure_hpa", 0)).alias("pressure"),
        X.falsy_default("wind_speed_mps", 0.0).cast("double").alias("wind_speed"),
        F.col("weather_condition").alias("condition"),
        F.col("weather_description").alias("description"),
        i(X.falsy_default("visibility_m", 10000)).alias("visibility"),
        i(X.falsy_default("cloudiness_pct", 0)).alias("clouds"),
        i(X.falsy_default("temp_min_c", X.falsy_default(temp, 0))).alias("temp_min"),
        i(X.falsy_default("temp_max_c", X.falsy_default(temp, 0))).alias("temp_max"),
        F.lit(0).alias("timezone_offset"),
        F.lit(0).cast("bigint").alias("sunrise_utc"),
        F.lit(0).cast("bigint").alias("sunset_utc"),
    )
