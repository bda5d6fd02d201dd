"""The seven observation reports and the store-side city statistics.

Each report is one hash aggregate (partial per task, final after a shuffle of at most
one row per group per task) followed by a sort of the small result. Group keys that are
NULL are dropped first, as pandas ``groupby`` does. Rounding is numpy's half-even
(``round_half_even``) except ``city_stats``, which mirrors SQL ``ROUND`` (half-up).
Every sort carries a final tie-break key so the order is total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.functions import expr as X

R = X.round_half_even


def _by_city(df: DataFrame) -> DataFrame:
    return df.where(F.col("city").isNotNull())


def city_temperature_summary(df: DataFrame) -> DataFrame:
    return (
        _by_city(df)
        .groupBy("city")
        .agg(
            F.count("temperature_c").alias("readings"),
            R(F.avg("temperature_c"), 2).alias("avg_temp_c"),
            R(F.min("temperature_c"), 2).alias("min_temp_c"),
            R(F.max("temperature_c"), 2).alias("max_temp_c"),
            R(F.avg("feels_like_c"), 2).alias("avg_feels_like"),
        )
        .orderBy(F.desc_nulls_last("avg_temp_c"), "city")
    )


def humidity_analysis(df: DataFrame) -> DataFrame:
    return (
        _by_city(df)
        .groupBy("city")
        .agg(
            R(F.avg("humidity_pct"), 1).alias("avg_humidity_pct"),
            F.max("humidity_pct").alias("max_humidity_pct"),
            F.min("humidity_pct").alias("min_humidity_pct"),
        )
        .orderBy(F.desc_nulls_last("avg_humidity_pct"), "city")
    )


def wind_speed_analysis(df: DataFrame) -> DataFrame:
    return (
        _by_city(df)
        .groupBy("city")
        .agg(
            R(F.avg("wind_speed_mps"), 2).alias("avg_wind_mps"),
            R(F.max("wind_speed_mps"), 2).alias("max_wind_mps"),
        )
        .orderBy(F.desc_nulls_last("avg_wind_mps"), "city")
    )


def common_weather_conditions(df: DataFrame) -> DataFrame:
    """Most frequent condition per city; ties go to the alphabetically first condition.

    The per-(city, condition) counts are a small aggregate (one row per pair). The pick
    per city is ``min(struct(-occurrences, condition))``: the smallest negated count is
    the largest count, and equal counts fall to the smaller condition. It is an
    algebraic aggregate with partials per task, so no window and no sort are needed.
    """
    counts = (
        df.where(F.col("city").isNotNull() & F.col("weather_condition").isNotNull())
        .groupBy("city", "weather_condition")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return _most_common(counts)


def _most_common(counts: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("occurrences")).alias("neg"), F.col("weather_condition").alias("condition")))
    return (
        counts.groupBy("city")
        .agg(best.alias("_best"))
        .select(
            "city",
            F.col("_best.condition").alias("most_common_condition"),
            (-F.col("_best.neg")).alias("occurrences"),
        )
        .orderBy("city")
    )


def daily_summary(df: DataFrame, approximate_cities: bool = False) -> DataFrame:
    distinct_cities = F.approx_count_distinct("city") if approximate_cities else F.count_distinct("city")
    return (
        df.withColumn("date", F.to_date("recorded_at"))
        .where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            R(F.avg("temperature_c"), 2).alias("avg_temp_c"),
            R(F.max("temperature_c"), 2).alias("max_temp_c"),
            R(F.min("temperature_c"), 2).alias("min_temp_c"),
            R(F.avg("humidity_pct"), 2).alias("avg_humidity"),
            distinct_cities.alias("cities_tracked"),
            F.count("temperature_c").alias("readings"),
        )
        .orderBy(F.desc("date"))
    )


def comfort_distribution(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("city").isNotNull() & F.col("comfort_level").isNotNull())
        .groupBy("city", "comfort_level")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("city", F.desc("count"), "comfort_level")
    )


def heat_index_comparison(df: DataFrame) -> DataFrame:
    """Difference of the *rounded* averages, rounded again."""
    out = (
        _by_city(df)
        .groupBy("city")
        .agg(
            R(F.avg("temperature_c"), 2).alias("avg_temp_c"),
            R(X.exact_mean("heat_index_c", 1), 2).alias("avg_heat_index_c"),
        )
    )
    return out.withColumn(
        "heat_difference_c", R(F.col("avg_heat_index_c") - F.col("avg_temp_c"), 2)
    ).orderBy(F.desc_nulls_last("heat_difference_c"), "city")


def city_stats(df: DataFrame) -> DataFrame:
    """Store-side statistics (SQL ``ROUND`` half-up, ``COUNT(*)``); NULL city is a group."""
    return (
        df.groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            F.round(F.avg("temperature_c"), 2).alias("avg_temp_c"),
            F.round(F.min("temperature_c"), 2).alias("min_temp_c"),
            F.round(F.max("temperature_c"), 2).alias("max_temp_c"),
            F.round(F.avg("humidity_pct"), 1).alias("avg_humidity_pct"),
            F.round(F.avg("wind_speed_mps"), 2).alias("avg_wind_speed_mps"),
            F.min("recorded_at").alias("first_reading"),
            F.max("recorded_at").alias("last_reading"),
        )
        .orderBy(F.desc_nulls_last("avg_temp_c"), "city")
    )


REPORTS = {
    "City Temperature Summary": city_temperature_summary,
    "Humidity Analysis": humidity_analysis,
    "Wind Speed Analysis": wind_speed_analysis,
    "Common Weather Conditions": common_weather_conditions,
    "Daily Summary": daily_summary,
    "Comfort Distribution": comfort_distribution,
    "Heat Index Comparison": heat_index_comparison,
}


# ---------------------------------------------------------------------------
# one roll-up for the whole bundle
# ---------------------------------------------------------------------------

ROLLUP_KEYS = ("city", "date", "weather_condition", "comfort_level")
ROLLUP_VALUES = ("temperature_c", "feels_like_c", "humidity_pct", "wind_speed_mps", "heat_index_c")
#: Sums are decimals with ten places: exact for readings of up to ten decimals, and the same
#: in whatever order rows and partial roll-ups are added.
ROLLUP_TYPE = "decimal(28,10)"


def rollup(df: DataFrame) -> DataFrame:
    """Rows, and count, sum, least and greatest of each value, per city, day, condition and
    comfort band: all that the seven reports need, in one scan of the observations."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in ROLLUP_VALUES:
        exact = F.col(c).try_cast(ROLLUP_TYPE)
        aggs += [F.count(exact).alias(f"{c}__n"), F.sum(exact).alias(f"{c}__sum"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return df.groupBy("city", F.to_date("recorded_at").alias("date"), "weather_condition", "comfort_level").agg(*aggs)


def merge_rollups(parts: DataFrame) -> DataFrame:
    """One roll-up of the rows of several (of batches, days or tables)."""
    fold = {"__min": F.min, "__max": F.max}
    rest = [c for c in parts.columns if c not in ROLLUP_KEYS]
    return parts.groupBy(*ROLLUP_KEYS).agg(*[fold.get(c[-5:], F.sum)(c).alias(c) for c in rest])


def _mean(c: str) -> Column:
    return F.sum(f"{c}__sum").cast("double") / F.sum(f"{c}__n").cast("double")


def reports_from_rollup(cells: DataFrame) -> dict[str, DataFrame]:
    """The seven reports from a roll-up: same columns, order and tie-breaks as over the rows.

    Means are exact decimal sums over counts; a mean that lies on a rounding tie can differ
    in its last place from a floating-point average of the rows.
    """
    n = lambda c: F.sum(f"{c}__n")
    lo, hi = (lambda c: F.min(f"{c}__min")), (lambda c: F.max(f"{c}__max"))
    city = _by_city(cells).groupBy("city")
    conditions = (
        cells.where(F.col("city").isNotNull() & F.col("weather_condition").isNotNull())
        .groupBy("city", "weather_condition")
        .agg(F.sum("rows").alias("occurrences"))
    )
    heat = city.agg(R(_mean("temperature_c"), 2).alias("avg_temp_c"), R(_mean("heat_index_c"), 2).alias("avg_heat_index_c"))
    return {
        "City Temperature Summary": city.agg(
            n("temperature_c").alias("readings"),
            R(_mean("temperature_c"), 2).alias("avg_temp_c"),
            R(lo("temperature_c"), 2).alias("min_temp_c"),
            R(hi("temperature_c"), 2).alias("max_temp_c"),
            R(_mean("feels_like_c"), 2).alias("avg_feels_like"),
        ).orderBy(F.desc_nulls_last("avg_temp_c"), "city"),
        "Humidity Analysis": city.agg(
            R(_mean("humidity_pct"), 1).alias("avg_humidity_pct"),
            hi("humidity_pct").alias("max_humidity_pct"),
            lo("humidity_pct").alias("min_humidity_pct"),
        ).orderBy(F.desc_nulls_last("avg_humidity_pct"), "city"),
        "Wind Speed Analysis": city.agg(
            R(_mean("wind_speed_mps"), 2).alias("avg_wind_mps"), R(hi("wind_speed_mps"), 2).alias("max_wind_mps")
        ).orderBy(F.desc_nulls_last("avg_wind_mps"), "city"),
        "Common Weather Conditions": _most_common(conditions),
        "Daily Summary": cells.where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            R(_mean("temperature_c"), 2).alias("avg_temp_c"),
            R(hi("temperature_c"), 2).alias("max_temp_c"),
            R(lo("temperature_c"), 2).alias("min_temp_c"),
            R(_mean("humidity_pct"), 2).alias("avg_humidity"),
            F.count_distinct("city").alias("cities_tracked"),
            n("temperature_c").alias("readings"),
        )
        .orderBy(F.desc("date")),
        "Comfort Distribution": cells.where(F.col("city").isNotNull() & F.col("comfort_level").isNotNull())
        .groupBy("city", "comfort_level")
        .agg(F.sum("rows").alias("count"))
        .orderBy("city", F.desc("count"), "comfort_level"),
        "Heat Index Comparison": heat.withColumn(
            "heat_difference_c", R(F.col("avg_heat_index_c") - F.col("avg_temp_c"), 2)
        ).orderBy(F.desc_nulls_last("heat_difference_c"), "city"),
    }


def metadata_from_rollup(cells: DataFrame) -> DataFrame:
    """:func:`report_metadata` from a roll-up."""
    return _metadata(cells.groupBy("city").agg(F.sum("rows").alias("_n")))


def generate_all_reports(df: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """All seven reports as lazy frames; {} when empty. With ``path`` the input is read once,
    for a roll-up written there, and the reports read that; without, each reads the input."""
    if path is None:
        return {} if df.isEmpty() else {name: fn(df) for name, fn in REPORTS.items()}
    rollup(df).write.mode("overwrite").parquet(path)
    cells = df.sparkSession.read.parquet(path)
    return {} if cells.isEmpty() else reports_from_rollup(cells)


def report_metadata(df: DataFrame) -> DataFrame:
    """Total records and the sorted distinct non-NULL cities joined by ", ".

    A per-city aggregate first (one row per city per task before the shuffle), then one
    global aggregate over those rows: the string is bounded by the number of cities,
    not by the number of observations. ``collect_list`` skips the NULL city group.
    """
    return _metadata(df.groupBy("city").agg(F.count(F.lit(1)).alias("_n")))


def _metadata(per_city: DataFrame) -> DataFrame:
    return per_city.agg(
        F.sum("_n").alias("total_records"),
        F.array_join(F.sort_array(F.collect_list("city")), ", ").alias("cities"),
    )
