"""Registry of the engine's queries: one Spark builder and (where SQL can say it) one
independent DuckDB oracle per key. ``__spark_entry__`` exposes this registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.functions import expr as X
from wxspark.operators import activity, quality, reports, transform
from wxspark.operators import load as load_op
from wxspark.plans import oracle as O
from wxspark.plans import views as V
from wxspark.sources import raw_json

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.with_views(sql)
        return fn

    return register


OBS_FINAL = (
    "obs_id, city, country, temperature_c, feels_like_c, temp_min_c, temp_max_c, humidity_pct, pressure_hpa, "
    "wind_speed_mps, wind_direction_deg, weather_condition, weather_description, visibility_m, cloudiness_pct, "
    "recorded_at, extracted_at, inserted_at, heat_index_c, comfort_level"
)

# ---------------------------------------------------------------------------
# quality engine
# ---------------------------------------------------------------------------


@query(
    "dq_summary",
    """
SELECT count(*) AS original_record_count,
       count(*) FILTER (WHERE NOT critical) AS clean_record_count,
       count(*) FILTER (WHERE critical) AS dropped_record_count,
       CASE WHEN count(*) > 0 THEN round_even(CAST(count(*) FILTER (WHERE NOT critical) AS DOUBLE) / count(*) * 100 * 10, 0) / 10
            ELSE CAST(0 AS DOUBLE) END AS pass_rate_pct,
       CAST((bool_or(f_null_city)::INT + bool_or(f_null_temperature_c)::INT + bool_or(f_null_humidity_pct)::INT
        + bool_or(f_null_pressure_hpa)::INT + bool_or(f_null_weather_condition)::INT + bool_or(f_null_recorded_at)::INT
        + bool_or(f_range_temperature_c)::INT + bool_or(f_range_humidity_pct)::INT + bool_or(f_range_pressure_hpa)::INT
        + bool_or(f_duplicate)::INT + bool_or(f_short_city)::INT) AS INTEGER) AS total_issues,
       CAST((bool_or(f_null_city)::INT + bool_or(f_null_temperature_c)::INT + bool_or(f_null_humidity_pct)::INT
        + bool_or(f_null_pressure_hpa)::INT + bool_or(f_null_weather_condition)::INT + bool_or(f_null_recorded_at)::INT
        + bool_or(f_range_temperature_c)::INT + bool_or(f_range_humidity_pct)::INT
        + bool_or(f_duplicate)::INT) AS INTEGER) AS critical_issues,
       CAST((bool_or(f_range_pressure_hpa)::INT + bool_or(f_short_city)::INT) AS INTEGER) AS warning_issues,
       CASE WHEN count(*) = 0 THEN 'SKIPPED' WHEN count(*) FILTER (WHERE critical) = 0 THEN 'PASSED' ELSE 'PARTIAL' END AS status
FROM flagged
""",
)
def q_dq_summary(spark, sf):
    return V.validation(spark, sf).summary()


ISSUE_ROWS = """
SELECT * FROM (
  SELECT 0 AS rule_order, 'NULL_VALUE' AS "check", 'city' AS "column", 'CRITICAL' AS severity, NULL::DOUBLE AS valid_min, NULL::DOUBLE AS valid_max,
         count(*) FILTER (WHERE f_null_city) AS affected_rows, min(obs_id) FILTER (WHERE f_null_city) AS first_row_id,
         max(obs_id) FILTER (WHERE f_null_city) AS last_row_id, NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value,
         'city must not be empty' AS message FROM flagged
  UNION ALL
  SELECT 1, 'NULL_VALUE', 'temperature_c', 'CRITICAL', NULL, NULL, count(*) FILTER (WHERE f_null_temperature_c),
         min(obs_id) FILTER (WHERE f_null_temperature_c), max(obs_id) FILTER (WHERE f_null_temperature_c), NULL, NULL,
         'temperature_c must not be empty' FROM flagged
  UNION ALL
  SELECT 2, 'NULL_VALUE', 'humidity_pct', 'CRITICAL', NULL, NULL, count(*) FILTER (WHERE f_null_humidity_pct),
         min(obs_id) FILTER (WHERE f_null_humidity_pct), max(obs_id) FILTER (WHERE f_null_humidity_pct), NULL, NULL,
         'humidity_pct must not be empty' FROM flagged
  UNION ALL
  SELECT 3, 'NULL_VALUE', 'pressure_hpa', 'CRITICAL', NULL, NULL, count(*) FILTER (WHERE f_null_pressure_hpa),
         min(obs_id) FILTER (WHERE f_null_pressure_hpa), max(obs_id) FILTER (WHERE f_null_pressure_hpa), NULL, NULL,
         'pressure_hpa must not be empty' FROM flagged
  UNION ALL
  SELECT 4, 'NULL_VALUE', 'weather_condition', 'CRITICAL', NULL, NULL, count(*) FILTER (WHERE f_null_weather_condition),
         min(obs_id) FILTER (WHERE f_null_weather_condition), max(obs_id) FILTER (WHERE f_null_weather_condition), NULL, NULL,
         'weather_condition must not be empty' FROM flagged
  UNION ALL
  SELECT 5, 'NULL_VALUE', 'recorded_at', 'CRITICAL', NULL, NULL, count(*) FILTER (WHERE f_null_recorded_at),
         min(obs_id) FILTER (WHERE f_null_recorded_at), max(obs_id) FILTER (WHERE f_null_recorded_at), NULL, NULL,
         'recorded_at must not be empty' FROM flagged
  UNION ALL
  SELECT 6, 'RANGE_VIOLATION', 'temperature_c', 'CRITICAL', -90.0::DOUBLE, 60.0::DOUBLE, count(*) FILTER (WHERE f_range_temperature_c),
         min(obs_id) FILTER (WHERE f_range_temperature_c), max(obs_id) FILTER (WHERE f_range_temperature_c),
         min(temperature_c) FILTER (WHERE f_range_temperature_c), max(temperature_c) FILTER (WHERE f_range_temperature_c),
         'temperature_c must lie from -90.0 to 60.0' FROM flagged
  UNION ALL
  SELECT 7, 'RANGE_VIOLATION', 'humidity_pct', 'CRITICAL', 0.0::DOUBLE, 100.0::DOUBLE, count(*) FILTER (WHERE f_range_humidity_pct),
         min(obs_id) FILTER (WHERE f_range_humidity_pct), max(obs_id) FILTER (WHERE f_range_humidity_pct),
         min(humidity_pct::DOUBLE) FILTER (WHERE f_range_humidity_pct), max(humidity_pct::DOUBLE) FILTER (WHERE f_range_humidity_pct),
         'humidity_pct must lie from 0 to 100' FROM flagged
  UNION ALL
  SELECT 8, 'RANGE_VIOLATION', 'pressure_hpa', 'WARNING', 870.0::DOUBLE, 1085.0::DOUBLE, count(*) FILTER (WHERE f_range_pressure_hpa),
         min(obs_id) FILTER (WHERE f_range_pressure_hpa), max(obs_id) FILTER (WHERE f_range_pressure_hpa),
         min(pressure_hpa::DOUBLE) FILTER (WHERE f_range_pressure_hpa), max(pressure_hpa::DOUBLE) FILTER (WHERE f_range_pressure_hpa),
         'pressure_hpa must lie from 870 to 1085' FROM flagged
  UNION ALL
  SELECT 9, 'DUPLICATE_RECORD', 'city,recorded_at', 'CRITICAL', NULL, NULL, count(*) FILTER (WHERE f_duplicate),
         min(obs_id) FILTER (WHERE f_duplicate), max(obs_id) FILTER (WHERE f_duplicate), NULL, NULL,
         'city, recorded_at: repeats an earlier row' FROM flagged
  UNION ALL
  SELECT 10, 'SUSPICIOUS_CITY_NAME', 'city', 'WARNING', NULL, NULL, count(*) FILTER (WHERE f_short_city),
         min(obs_id) FILTER (WHERE f_short_city), max(obs_id) FILTER (WHERE f_short_city), NULL, NULL,
         'city needs 2 characters or more' FROM flagged
) i WHERE affected_rows > 0
"""


def _sample_sql(flag: str, value: str) -> str:
    """DuckDB's ids and values of the first rows of a rule, comma-joined; ``value`` '' has none."""
    rows = f"(SELECT obs_id, {value or 'NULL'} AS v FROM flagged WHERE f_{flag} ORDER BY obs_id LIMIT {quality.SAMPLE_ROWS})"
    values = f"(SELECT string_agg(CAST(v::DOUBLE AS VARCHAR), ',' ORDER BY obs_id) FROM {rows})" if value else "''"
    return f"(SELECT string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY obs_id) FROM {rows}) AS sample_ids, {values} AS sample_values"


ISSUE_SAMPLES = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {pos} AS rule_order, {_sample_sql(flag, value)}"
    for pos, (flag, value) in enumerate(
        [(f"null_{c}", "") for c in ("city", "temperature_c", "humidity_pct", "pressure_hpa", "weather_condition", "recorded_at")]
        + [(f"range_{c}", c) for c in ("temperature_c", "humidity_pct", "pressure_hpa")]
        + [("duplicate", ""), ("short_city", "")]
    )
) + ") s"


@query("dq_issues", f"SELECT i.*, s.sample_ids, coalesce(s.sample_values, '') AS sample_values FROM ({ISSUE_ROWS}) i JOIN ({ISSUE_SAMPLES}) s USING (rule_order)")
def q_dq_issues(spark, sf):
    """Every rule that fired; the lists of sampled ids and values as comma-joined text."""
    text = lambda c: F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")
    return V.validation(spark, sf).issues().withColumns({c: text(c) for c in ("sample_ids", "sample_values")})


@query(
    "dq_nulls",
    """
SELECT obs_id, concat_ws(',',
         CASE WHEN city IS NULL THEN 'city' END, CASE WHEN temperature_c IS NULL THEN 'temperature_c' END,
         CASE WHEN humidity_pct IS NULL THEN 'humidity_pct' END, CASE WHEN pressure_hpa IS NULL THEN 'pressure_hpa' END,
         CASE WHEN weather_condition IS NULL THEN 'weather_condition' END,
         CASE WHEN recorded_at IS NULL THEN 'recorded_at' END) AS null_columns
FROM obs
WHERE city IS NULL OR temperature_c IS NULL OR humidity_pct IS NULL OR pressure_hpa IS NULL
   OR weather_condition IS NULL OR recorded_at IS NULL
""",
)
def q_dq_nulls(spark, sf):
    """R1 detail: every row with a NULL required column and which columns are NULL."""
    df = V.obs(spark, sf)
    cols = quality.REQUIRED_COLUMNS
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(any_null).select("obs_id", names.alias("null_columns"))


def _range_detail(column: str, lo, hi):
    def fn(spark, sf):
        rule = quality.range_rule(column, lo, hi)
        return V.obs(spark, sf).where(rule.violation_col()).select("obs_id", F.col(column).alias("value"))

    sql = f"SELECT obs_id, {column} AS value FROM obs WHERE {column} < {lo} OR {column} > {hi}"
    return fn, sql


for _col, (_lo, _hi), _key in (
    ("temperature_c", quality.TEMP_RANGE, "dq_range_temperature"),
    ("humidity_pct", quality.HUMIDITY_RANGE, "dq_range_humidity"),
    ("pressure_hpa", quality.PRESSURE_RANGE, "dq_range_pressure"),
):
    _fn, _sql = _range_detail(_col, _lo, _hi)
    query(_key, _sql)(_fn)


@query(
    "dq_duplicates",
    """
SELECT obs_id, city, recorded_at, first_obs_id FROM flagged WHERE f_duplicate
""",
)
def q_dq_duplicates(spark, sf):
    """R5 detail: every duplicate (not first) row and the first row it repeats."""
    df = quality.mark_duplicates(V.obs(spark, sf), first_col="first_obs_id")
    return df.where("_is_duplicate").select("obs_id", "city", "recorded_at", "first_obs_id")


@query(
    "dq_city_name",
    """
SELECT obs_id, city FROM obs WHERE length(city) < 2
""",
)
def q_dq_city_name(spark, sf):
    rule = quality.short_text_rule("city")
    return V.obs(spark, sf).where(rule.violation_col()).select("obs_id", "city")


@query("dq_clean", f"SELECT {OBS_FINAL} FROM clean")
def q_dq_clean(spark, sf):
    return V.clean(spark, sf)


@query(
    "dq_quarantine",
    f"""
SELECT {OBS_FINAL}, concat_ws(',',
  CASE WHEN f_null_city THEN 'null_city' END, CASE WHEN f_null_temperature_c THEN 'null_temperature_c' END,
  CASE WHEN f_null_humidity_pct THEN 'null_humidity_pct' END, CASE WHEN f_null_pressure_hpa THEN 'null_pressure_hpa' END,
  CASE WHEN f_null_weather_condition THEN 'null_weather_condition' END, CASE WHEN f_null_recorded_at THEN 'null_recorded_at' END,
  CASE WHEN f_range_temperature_c THEN 'range_temperature_c' END, CASE WHEN f_range_humidity_pct THEN 'range_humidity_pct' END,
  CASE WHEN f_range_pressure_hpa THEN 'range_pressure_hpa' END, CASE WHEN f_duplicate THEN 'duplicate' END,
  CASE WHEN f_short_city THEN 'short_city' END) AS issue_list
FROM flagged WHERE critical
""",
)
def q_dq_quarantine(spark, sf):
    return V.validation(spark, sf).quarantine


PART = """(SELECT * REPLACE (CASE WHEN visibility_m = 0 THEN NULL ELSE weather_description END AS weather_description,
  CASE WHEN wind_direction_deg < 90 THEN NULL ELSE wind_speed_mps END AS wind_speed_mps) FROM clean)"""


@query(
    "dq_null_counts",
    f"""
SELECT * FROM (
  SELECT 'country' AS "column", count(*) FILTER (WHERE country IS NULL) AS null_count FROM {PART}
  UNION ALL SELECT 'feels_like_c', count(*) FILTER (WHERE feels_like_c IS NULL) FROM {PART}
  UNION ALL SELECT 'temp_min_c', count(*) FILTER (WHERE temp_min_c IS NULL) FROM {PART}
  UNION ALL SELECT 'temp_max_c', count(*) FILTER (WHERE temp_max_c IS NULL) FROM {PART}
  UNION ALL SELECT 'wind_speed_mps', count(*) FILTER (WHERE wind_speed_mps IS NULL) FROM {PART}
  UNION ALL SELECT 'wind_direction_deg', count(*) FILTER (WHERE wind_direction_deg IS NULL) FROM {PART}
  UNION ALL SELECT 'weather_description', count(*) FILTER (WHERE weather_description IS NULL) FROM {PART}
  UNION ALL SELECT 'visibility_m', count(*) FILTER (WHERE visibility_m IS NULL) FROM {PART}
  UNION ALL SELECT 'cloudiness_pct', count(*) FILTER (WHERE cloudiness_pct IS NULL) FROM {PART}
  UNION ALL SELECT 'extracted_at', count(*) FILTER (WHERE extracted_at IS NULL) FROM {PART}
  UNION ALL SELECT 'inserted_at', count(*) FILTER (WHERE inserted_at IS NULL) FROM {PART}
  UNION ALL SELECT 'heat_index_c', count(*) FILTER (WHERE heat_index_c IS NULL) FROM {PART}
  UNION ALL SELECT 'comfort_level', count(*) FILTER (WHERE comfort_level IS NULL) FROM {PART}
) n WHERE null_count > 0
""",
)
def q_dq_null_counts(spark, sf):
    """NULLs by column of a batch whose optional description and wind are missing in part."""
    seen = V.transformed(spark, sf).withColumns(
        {
            "weather_description": F.when(F.col("visibility_m") != 0, F.col("weather_description")),
            "wind_speed_mps": F.when(F.col("wind_direction_deg") >= 90, F.col("wind_speed_mps")),
        }
    )
    return quality.validate(seen).null_counts()


# ---------------------------------------------------------------------------
# reports (A1-A8)
# ---------------------------------------------------------------------------

R = O.rnd


@query(
    "city_temperature_summary",
    f"""
SELECT city, count(temperature_c) AS readings, {R('avg(temperature_c)', 2)} AS avg_temp_c,
       {R('min(temperature_c)', 2)} AS min_temp_c, {R('max(temperature_c)', 2)} AS max_temp_c,
       {R('avg(feels_like_c)', 2)} AS avg_feels_like
FROM clean WHERE city IS NOT NULL GROUP BY city
""",
)
def q_city_temperature_summary(spark, sf):
    return reports.city_temperature_summary(V.clean(spark, sf))


@query(
    "humidity_analysis",
    f"""
SELECT city, {R('avg(humidity_pct)', 1)} AS avg_humidity_pct, max(humidity_pct) AS max_humidity_pct,
       min(humidity_pct) AS min_humidity_pct
FROM clean WHERE city IS NOT NULL GROUP BY city
""",
)
def q_humidity_analysis(spark, sf):
    return reports.humidity_analysis(V.clean(spark, sf))


@query(
    "wind_speed_analysis",
    f"""
SELECT city, {R('avg(wind_speed_mps)', 2)} AS avg_wind_mps, {R('max(wind_speed_mps)', 2)} AS max_wind_mps
FROM clean WHERE city IS NOT NULL GROUP BY city
""",
)
def q_wind_speed_analysis(spark, sf):
    return reports.wind_speed_analysis(V.clean(spark, sf))


@query(
    "common_weather_conditions",
    """
SELECT city, weather_condition AS most_common_condition, occurrences FROM (
  SELECT city, weather_condition, count(*) AS occurrences,
         row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, weather_condition) AS rk
  FROM clean WHERE city IS NOT NULL AND weather_condition IS NOT NULL
  GROUP BY city, weather_condition
) t WHERE rk = 1
""",
)
def q_common_weather_conditions(spark, sf):
    return reports.common_weather_conditions(V.clean(spark, sf))


@query(
    "daily_summary",
    f"""
SELECT CAST(recorded_at AS DATE) AS date, {R('avg(temperature_c)', 2)} AS avg_temp_c,
       {R('max(temperature_c)', 2)} AS max_temp_c, {R('min(temperature_c)', 2)} AS min_temp_c,
       {R('avg(humidity_pct)', 2)} AS avg_humidity, count(DISTINCT city) AS cities_tracked,
       count(temperature_c) AS readings
FROM clean WHERE recorded_at IS NOT NULL GROUP BY 1
""",
)
def q_daily_summary(spark, sf):
    return reports.daily_summary(V.clean(spark, sf))


@query(
    "comfort_distribution",
    """
SELECT city, comfort_level, count(*) AS "count"
FROM clean WHERE city IS NOT NULL AND comfort_level IS NOT NULL GROUP BY city, comfort_level
""",
)
def q_comfort_distribution(spark, sf):
    return reports.comfort_distribution(V.clean(spark, sf))


@query(
    "heat_index_comparison",
    f"""
SELECT city, avg_temp_c, avg_heat_index_c, {R('avg_heat_index_c - avg_temp_c', 2)} AS heat_difference_c
FROM (SELECT city, {R('avg(temperature_c)', 2)} AS avg_temp_c, {R('CAST(sum(CAST(round_even(heat_index_c * 10, 0) AS BIGINT)) AS DOUBLE) / (count(heat_index_c) * CAST(10 AS DOUBLE))', 2)} AS avg_heat_index_c
      FROM clean WHERE city IS NOT NULL GROUP BY city) t
""",
)
def q_heat_index_comparison(spark, sf):
    return reports.heat_index_comparison(V.clean(spark, sf))


@query(
    "city_stats",
    """
SELECT city, count(*) AS total_readings, round(avg(temperature_c), 2) AS avg_temp_c,
       round(min(temperature_c), 2) AS min_temp_c, round(max(temperature_c), 2) AS max_temp_c,
       round(avg(humidity_pct), 1) AS avg_humidity_pct, round(avg(wind_speed_mps), 2) AS avg_wind_speed_mps,
       min(recorded_at) AS first_reading, max(recorded_at) AS last_reading
FROM stored GROUP BY city
""",
)
def q_city_stats(spark, sf):
    return reports.city_stats(V.stored(spark, sf))


@query(
    "report_metadata",
    """
SELECT count(*) AS total_records,
       (SELECT string_agg(city, ', ' ORDER BY city) FROM (SELECT DISTINCT city FROM stored WHERE city IS NOT NULL) c) AS cities
FROM stored
""",
)
def q_report_metadata(spark, sf):
    return reports.report_metadata(V.stored(spark, sf))


# ---------------------------------------------------------------------------
# stored table, dashboard and search activity
# ---------------------------------------------------------------------------

STORED_COLS = f"id, {OBS_FINAL}, date"


@query("fetch_all", f"SELECT {STORED_COLS} FROM stored ORDER BY recorded_at DESC, inserted_at DESC, obs_id")
def q_fetch_all(spark, sf):
    return activity.fetch_all(V.stored(spark, sf))


@query(
    "recent_searches",
    """
SELECT inserted_at AS "Search Time", city AS "City", temperature_c AS "Temp (°C)", humidity_pct AS "Humidity (%)",
       pressure_hpa AS "Pressure (hPa)", weather_condition AS "Condition"
FROM stored ORDER BY recorded_at DESC, inserted_at DESC, obs_id LIMIT 20
""",
)
def q_recent_searches(spark, sf):
    return activity.recent_searches(V.stored(spark, sf))


CITY_COUNTS_SQL = """
SELECT city AS "City", count(*) AS "Search Count" FROM stored WHERE city IS NOT NULL GROUP BY city
"""


@query("city_search_counts", CITY_COUNTS_SQL)
def q_city_search_counts(spark, sf):
    return activity.city_search_counts(V.stored(spark, sf))


@query("top5_cities", CITY_COUNTS_SQL + ' ORDER BY "Search Count" DESC, "City" LIMIT 5')
def q_top5_cities(spark, sf):
    return activity.top_cities(V.stored(spark, sf))


@query(
    "hourly_activity",
    """
SELECT s.h AS "Hour", coalesce(c.n, 0) AS "Searches"
FROM (SELECT unnest(generate_series(date_trunc('hour', min(inserted_at)), date_trunc('hour', max(inserted_at)),
                                    INTERVAL 1 HOUR)) AS h FROM stored) s
LEFT JOIN (SELECT date_trunc('hour', inserted_at) AS h, count(*) AS n FROM stored
           WHERE inserted_at IS NOT NULL GROUP BY 1) c ON s.h = c.h
""",
)
def q_hourly_activity(spark, sf):
    return activity.hourly_activity(V.stored(spark, sf))


@query(
    "hourly_window_counts",
    """
SELECT date_trunc('hour', inserted_at) AS window_start, date_trunc('hour', inserted_at) + INTERVAL 1 HOUR AS window_end,
       count(*) AS searches
FROM stored WHERE inserted_at IS NOT NULL GROUP BY 1, 2
""",
)
def q_hourly_window_counts(spark, sf):
    return activity.hourly_window_counts(V.stored(spark, sf))


@query(
    "kpi_row",
    f"""
SELECT count(*) AS records, {R('avg(temperature_c)', 1)} AS avg_temp_c, {R('avg(humidity_pct)', 1)} AS avg_humidity_pct,
       {R('avg(pressure_hpa)', 1)} AS avg_pressure_hpa, count(DISTINCT city) AS cities
FROM stored
""",
)
def q_kpi_row(spark, sf):
    return activity.kpi_row(V.stored(spark, sf))


@query(
    "city_mean_temperature",
    "SELECT city, avg(temperature_c) AS mean_temperature_c FROM stored WHERE city IS NOT NULL GROUP BY city",
)
def q_city_mean_temperature(spark, sf):
    return activity.city_mean_temperature(V.stored(spark, sf))


@query(
    "condition_distribution",
    """
SELECT coalesce(weather_condition, 'Unknown') AS weather_condition, count(*) AS "count" FROM obs GROUP BY 1
""",
)
def q_condition_distribution(spark, sf):
    """Over every received observation (the feed still has NULL conditions)."""
    return activity.condition_distribution(V.obs(spark, sf))


@query("temperature_trend", "SELECT recorded_at, temperature_c FROM stored ORDER BY recorded_at, obs_id")
def q_temperature_trend(spark, sf):
    return activity.series(V.stored(spark, sf), "temperature_c")


@query("humidity_trend", "SELECT recorded_at, humidity_pct FROM stored ORDER BY recorded_at, obs_id")
def q_humidity_trend(spark, sf):
    return activity.series(V.stored(spark, sf), "humidity_pct")


@query(
    "fetch_latest",
    f"""
SELECT t.* FROM tr t
JOIN (SELECT city, max(recorded_at) AS max_ts FROM tr GROUP BY city) l
  ON t.city = l.city AND t.recorded_at = l.max_ts
""",
)
def q_fetch_latest(spark, sf):
    """Join form over the raw feed, where several readings share the latest hour."""
    return activity.fetch_latest(V.transformed(spark, sf))


@query(
    "fetch_latest_window",
    f"""
SELECT {STORED_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY recorded_at DESC, inserted_at DESC, obs_id) AS rn
  FROM stored WHERE city IS NOT NULL
) t WHERE rn = 1
""",
)
def q_fetch_latest_window(spark, sf):
    return activity.latest_per_city(V.stored(spark, sf))


LOOKUP_CITY = "nation_3"


@query(
    "fresh_city_lookup",
    f"""
SELECT {STORED_COLS} FROM stored
WHERE lower(city) = lower('{LOOKUP_CITY}')
  AND inserted_at >= (SELECT max(inserted_at) FROM stored WHERE lower(city) = lower('{LOOKUP_CITY}')) - INTERVAL 60 SECOND
ORDER BY inserted_at DESC, obs_id LIMIT 1
""",
)
def q_fresh_city_lookup(spark, sf):
    """Live-page lookup for one city, as of the moment of that city's latest reading."""
    st = V.stored(spark, sf)
    as_of = st.where(F.lower("city") == F.lower(F.lit(LOOKUP_CITY))).agg(F.max("inserted_at")).scalar()
    return activity.fresh_city_lookup(st, LOOKUP_CITY, as_of)


@query(
    "fresh_city_bulk",
    """
SELECT r.city AS requested_city, CASE WHEN b.id IS NULL THEN 'stale' ELSE 'fresh' END AS status, b.id, b.inserted_at
FROM (SELECT DISTINCT city FROM stored) r
LEFT JOIN (
  SELECT lower(city) AS k, id, inserted_at FROM (
    SELECT *, row_number() OVER (PARTITION BY lower(city) ORDER BY inserted_at DESC, obs_id) AS rn
    FROM stored WHERE inserted_at >= (SELECT max(inserted_at) FROM stored) - INTERVAL 60 SECOND) f
  WHERE rn = 1
) b ON lower(r.city) = b.k
""",
)
def q_fresh_city_bulk(spark, sf):
    """Every stored city requested at once, as of the newest insert: fresh or stale."""
    st = V.stored(spark, sf)
    as_of = st.agg(F.max("inserted_at")).scalar()
    return activity.fresh_city_bulk(st.select("city"), st, as_of)


@query(
    "cached_record_defaults",
    """
SELECT id, city, country,
       CAST(trunc(coalesce(nullif(temperature_c, 0), 0)) AS INTEGER) AS temperature,
       CAST(trunc(coalesce(nullif(feels_like_c, 0), 0)) AS INTEGER) AS feels_like,
       CAST(coalesce(nullif(humidity_pct, 0), 0) AS INTEGER) AS humidity,
       CAST(coalesce(nullif(pressure_hpa, 0), 0) AS INTEGER) AS pressure,
       CAST(coalesce(nullif(wind_speed_mps, 0), 0) AS DOUBLE) AS wind_speed,
       weather_condition AS condition, weather_description AS description,
       CAST(coalesce(nullif(visibility_m, 0), 10000) AS INTEGER) AS visibility,
       CAST(coalesce(nullif(cloudiness_pct, 0), 0) AS INTEGER) AS clouds,
       CAST(trunc(coalesce(nullif(temp_min_c, 0), nullif(temperature_c, 0), 0)) AS INTEGER) AS temp_min,
       CAST(trunc(coalesce(nullif(temp_max_c, 0), nullif(temperature_c, 0), 0)) AS INTEGER) AS temp_max,
       0 AS timezone_offset, CAST(0 AS BIGINT) AS sunrise_utc, CAST(0 AS BIGINT) AS sunset_utc
FROM stored
""",
)
def q_cached_record_defaults(spark, sf):
    return activity.cached_record(V.stored(spark, sf))


# ---------------------------------------------------------------------------
# projections and keys (P5, L4)
# ---------------------------------------------------------------------------


@query("observation_projection", f"SELECT {OBS_FINAL} FROM tr")
def q_observation_projection(spark, sf):
    return transform.final_projection(V.transformed(spark, sf))


@query(
    "surrogate_key",
    "SELECT obs_id, md5(concat_ws('|', city, strftime(recorded_at, '%Y-%m-%d %H:%M:%S'))) AS id FROM obs",
)
def q_surrogate_key(spark, sf):
    return V.obs(spark, sf).select("obs_id", transform.surrogate_key().alias("id"))


# ---------------------------------------------------------------------------
# raw responses
# ---------------------------------------------------------------------------




TITLE_SQL = (
    "array_to_string(list_transform(range(1, length({s}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches("
    "substr({s}, i - 1, 1), '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]') THEN upper(substr({s}, i, 1)) ELSE lower(substr({s}, i, 1)) END), '')"
)


def title_sql(s: str) -> str:
    return TITLE_SQL.format(s=s)


@query(
    "raw_json_parse",
    f"""
SELECT obs_id, coalesce(city, '') AS city, coalesce(country, '') AS country, temperature_c, feels_like_c,
       temp_min_c, temp_max_c, humidity_pct, pressure_hpa, wind_speed_mps, wind_direction_deg,
       coalesce(weather_condition, '') AS weather_condition,
       {title_sql("coalesce(weather_description, '')")} AS weather_description,
       visibility_m, cloudiness_pct, recorded_at, extracted_at
FROM obs
""",
)
def q_raw_json_parse(spark, sf):
    """Observations -> raw JSON documents -> parsed back with the tolerant RAW schema."""
    good, _ = raw_json.split_raw(V.parsed_docs(spark, sf), keep=("obs_id",))
    return good


@query(
    "raw_json_rejects",
    """
SELECT * FROM (
  SELECT obs_id, CASE WHEN temperature_c IS NULL THEN 'malformed_json' WHEN obs_id % 13 = 0 THEN 'dt_out_of_range'
                      WHEN obs_id % 17 = 0 THEN 'non_numeric_dt' END AS reason FROM obs)
WHERE reason IS NOT NULL
""",
)
def q_raw_json_rejects(spark, sf):
    """Documents truncated in transit where a reading is missing, and with times beyond the
    calendar or without a number: exactly those rows are rejected, each with its reason."""
    d = V.raw_docs(spark, sf)
    timed = lambda text: F.regexp_replace("doc", '"dt":-?[0-9]+', f'"dt":"{text}"')
    d = d.withColumn("doc", F.when(F.col("obs_id") % 13 == 0, timed("1e15")).when(F.col("obs_id") % 17 == 0, timed("soon")).otherwise(F.col("doc")))
    cut = F.when(F.col("doc").contains('"main":{"feels_like"'), F.expr("substr(doc, 1, length(doc) - 1)")).otherwise(
        F.col("doc")
    )
    parsed = raw_json.parse_docs(d, cut, keep=("obs_id", "inserted_at"))
    _, bad = raw_json.split_raw(parsed, keep=("obs_id",))
    return bad.select("obs_id", "reason")


@query(
    "tolerant_cast",
    f"SELECT {OBS_FINAL} FROM tr",
)
def q_tolerant_cast(spark, sf):
    """Observations written as text (as the CSV sink does) and re-typed tolerantly."""
    t = V.transformed(spark, sf)
    text = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    return transform.final_projection(transform.tolerant_cast(text).withColumn("obs_id", F.col("obs_id").cast("bigint")))


@query(
    "live_profile_projection",
    f"""
SELECT obs_id, city, country, round_even(temperature_c, 0) AS temperature_c, round_even(feels_like_c, 0) AS feels_like_c,
       round_even(coalesce(temp_min_c, temperature_c), 0) AS temp_min_c,
       round_even(coalesce(temp_max_c, temperature_c), 0) AS temp_max_c,
       humidity_pct, pressure_hpa, wind_speed_mps, CAST(NULL AS INTEGER) AS wind_direction_deg,
       weather_condition, weather_description, coalesce(visibility_m, 10000) AS visibility_m,
       coalesce(cloudiness_pct, 0) AS cloudiness_pct, CAST(NULL AS DOUBLE) AS heat_index_c,
       {O.comfort_sql('round_even(temperature_c, 0)', 'live')} AS comfort_level,
       inserted_at AS recorded_at, inserted_at AS extracted_at
FROM obs
WHERE city IS NOT NULL AND country IS NOT NULL AND temperature_c IS NOT NULL AND feels_like_c IS NOT NULL
  AND humidity_pct IS NOT NULL AND pressure_hpa IS NOT NULL AND wind_speed_mps IS NOT NULL
  AND weather_condition IS NOT NULL AND weather_description IS NOT NULL
""",
)
def q_live_profile_projection(spark, sf):
    p = V.parsed_docs(spark, sf)
    return raw_json.flatten_live(p, F.col("inserted_at"), keep=("obs_id",))


@query(
    "epoch_to_timestamp",
    "SELECT obs_id, CAST(floor(epoch(inserted_at)) AS BIGINT) AS dt, CAST(to_timestamp(floor(epoch(inserted_at))) AS TIMESTAMP) AS recorded_ts FROM obs",
)
def q_epoch_to_timestamp(spark, sf):
    o = V.obs(spark, sf).select("obs_id", F.unix_timestamp(F.col("inserted_at").cast("timestamp")).alias("dt"))
    return o.select("obs_id", "dt", X.epoch_to_timestamp(F.col("dt").cast("string")).alias("recorded_ts"))


@query(
    "iso_truncate",
    "SELECT obs_id, strftime(inserted_at, '%Y-%m-%dT%H:%M:%S.%f') AS iso, date_trunc('second', inserted_at) AS extracted_at FROM obs",
)
def q_iso_truncate(spark, sf):
    o = V.obs(spark, sf).select("obs_id", F.date_format("inserted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"))
    return o.select("obs_id", "iso", X.iso_truncate("iso").alias("extracted_at"))


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------


@query(
    "title_case",
    f"""
SELECT obs_id, {title_sql('city')} AS city_title, {title_sql('weather_description')} AS description_title FROM obs
""",
)
def q_title_case(spark, sf):
    o = V.obs(spark, sf)
    return o.select(
        "obs_id",
        X.title_case("city").alias("city_title"),
        X.title_case("weather_description").alias("description_title"),
    )


@query(
    "heat_index",
    f"""
SELECT obs_id, {O.heat_index_sql('temperature_c', 'humidity_pct')} AS heat_index_c,
       CASE WHEN temperature_c > 27 AND humidity_pct > 40 THEN {O.heat_index_sql('temperature_c', 'humidity_pct')} END
         AS heat_index_guarded_c
FROM obs
""",
)
def q_heat_index(spark, sf):
    o = V.obs(spark, sf)
    return o.select(
        "obs_id",
        X.heat_index("temperature_c", "humidity_pct").alias("heat_index_c"),
        X.heat_index("temperature_c", "humidity_pct", guarded=True).alias("heat_index_guarded_c"),
    )


@query("comfort_batch", f"SELECT obs_id, {O.comfort_sql('temperature_c', 'batch')} AS comfort_level FROM obs")
def q_comfort_batch(spark, sf):
    return V.obs(spark, sf).select("obs_id", X.comfort_level("temperature_c", "batch").alias("comfort_level"))


@query("comfort_live", f"SELECT obs_id, {O.comfort_sql('temperature_c', 'live')} AS comfort_level FROM obs")
def q_comfort_live(spark, sf):
    return V.obs(spark, sf).select("obs_id", X.comfort_level("temperature_c", "live").alias("comfort_level"))


# Viewer zone used by the display queries: UTC+05:30.
DISPLAY_OFFSET_SECONDS = 19800

TOD_SQL = (
    "CASE WHEN hour({t}) IS NULL THEN NULL WHEN hour({t}) >= 20 OR hour({t}) < 5 THEN 'night' "
    "WHEN hour({t}) < 7 THEN 'dawn' WHEN hour({t}) < 17 THEN 'day' ELSE 'dusk' END"
)
LOCAL_SQL = f"(inserted_at + INTERVAL {DISPLAY_OFFSET_SECONDS} SECOND)"


def _local(o):
    return o.withColumn("local_time", X.local_time("inserted_at", F.lit(DISPLAY_OFFSET_SECONDS)))


@query("city_local_time", f"SELECT obs_id, {LOCAL_SQL} AS local_time FROM obs")
def q_city_local_time(spark, sf):
    return _local(V.obs(spark, sf)).select("obs_id", "local_time")


@query("time_of_day", f"SELECT obs_id, {TOD_SQL.format(t=LOCAL_SQL)} AS time_of_day FROM obs")
def q_time_of_day(spark, sf):
    return _local(V.obs(spark, sf)).select("obs_id", X.time_of_day("local_time").alias("time_of_day"))


@query(
    "local_clock_label",
    f"""
SELECT obs_id, ltrim(strftime(CAST(to_timestamp(epoch(recorded_at)::BIGINT + {DISPLAY_OFFSET_SECONDS}) AS TIMESTAMP),
                              '%I:%M %p'), '0') AS clock_label
FROM obs
""",
)
def q_local_clock_label(spark, sf):
    o = V.obs(spark, sf)
    epoch = F.unix_timestamp(F.col("recorded_at").cast("timestamp"))
    return o.select("obs_id", X.local_clock_label(epoch, F.lit(DISPLAY_OFFSET_SECONDS)).alias("clock_label"))


ICON_SQL = (
    "CASE WHEN {c} = 'Clear' THEN CASE {tod} WHEN 'night' THEN '🌙' WHEN 'dawn' THEN '🌄' WHEN 'dusk' THEN '🌄' ELSE '☀️' END "
    "WHEN {c} = 'Clouds' THEN '☁️' WHEN {c} = 'Rain' THEN '🌧️' WHEN {c} = 'Drizzle' THEN '🌦️' "
    "WHEN {c} = 'Thunderstorm' THEN '⛈️' WHEN {c} = 'Snow' THEN '❄️' WHEN {c} IN ('Mist', 'Fog', 'Haze') THEN '🌫️' "
    "WHEN {c} = 'Smoke' THEN '💨' WHEN {c} IN ('Dust', 'Sand', 'Tornado') THEN '🌪️' ELSE '🌤️' END"
)


@query(
    "condition_icon",
    f"SELECT obs_id, {ICON_SQL.format(c='weather_condition', tod=TOD_SQL.format(t=LOCAL_SQL))} AS icon FROM obs",
)
def q_condition_icon(spark, sf):
    o = _local(V.obs(spark, sf))
    return o.select("obs_id", X.condition_icon("weather_condition", X.time_of_day("local_time")).alias("icon"))


@query(
    "gauge_percentages",
    f"""
SELECT id, {O.rnd('visibility_m / 1000.0', 1)} AS visibility_km,
       coalesce(humidity_pct, 50) AS humidity_gauge,
       CASE WHEN wind_speed_mps IS NULL THEN 30 ELSE least(100, CAST(trunc(wind_speed_mps / 25.0 * 100) AS INTEGER)) END
         AS wind_gauge,
       CASE WHEN pressure_hpa IS NULL THEN 60
            ELSE greatest(0, least(100, CAST(trunc((pressure_hpa - 870.0) / 215.0 * 100) AS INTEGER))) END AS pressure_gauge,
       CASE WHEN visibility_m IS NULL THEN 75
            ELSE least(100, CAST(trunc({O.rnd('visibility_m / 1000.0', 1)} / 15.0 * 100) AS INTEGER)) END AS visibility_gauge,
       coalesce(cloudiness_pct, 40) AS clouds_gauge
FROM stored
""",
)
def q_gauge_percentages(spark, sf):
    st = V.stored(spark, sf)
    return st.select(
        "id",
        X.visibility_km("visibility_m").alias("visibility_km"),
        X.gauge_humidity_pct("humidity_pct").alias("humidity_gauge"),
        X.gauge_wind_pct("wind_speed_mps").alias("wind_gauge"),
        X.gauge_pressure_pct("pressure_hpa").alias("pressure_gauge"),
        X.gauge_visibility_pct("visibility_m").alias("visibility_gauge"),
        X.gauge_clouds_pct("cloudiness_pct").alias("clouds_gauge"),
    )


# ---------------------------------------------------------------------------
# keyed load (L2-L4, J2): batch A = readings of the first half of the feed's time range,
# then batch B = the whole feed re-delivered (replay), both into the same table
# ---------------------------------------------------------------------------

SPLIT_SQL = "(SELECT make_timestamp((epoch_us(min(inserted_at)) + epoch_us(max(inserted_at))) // 2) FROM obs)"

LOAD_CTES = f"""
, ba AS (SELECT * FROM tr WHERE inserted_at < {SPLIT_SQL}),
ta AS (SELECT * FROM ba WHERE city IS NOT NULL AND recorded_at IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY city, recorded_at ORDER BY obs_id) = 1),
tb AS (SELECT * FROM tr b WHERE city IS NOT NULL AND recorded_at IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM ta WHERE ta.city = b.city AND ta.recorded_at = b.recorded_at)
       QUALIFY row_number() OVER (PARTITION BY city, recorded_at ORDER BY obs_id) = 1)
"""


def _load_batches(spark, sf):
    t = V.transformed(spark, sf)
    mid = t.agg(
        F.timestamp_micros(
            F.floor((F.unix_micros(F.min("inserted_at").cast("timestamp")) + F.unix_micros(F.max("inserted_at").cast("timestamp"))) / 2).cast("bigint")
        ).cast("timestamp_ntz")
    ).scalar()
    a = transform.to_stored(t.where(F.col("inserted_at") < mid))
    b = transform.to_stored(t)
    return a, b


@query("load_insert_if_absent")
def q_load_insert_if_absent(spark, sf):
    """Table contents after loading A into an empty table, then B on top."""
    a, b = _load_batches(spark, sf)
    ins_a = load_op.insert_if_absent(a, None)
    ins_b = load_op.insert_if_absent(b, ins_a)
    cols = ["obs_id", "id", "city", "recorded_at"]
    return ins_a.select(*cols, F.lit("A").alias("load_batch")).unionByName(ins_b.select(*cols, F.lit("B").alias("load_batch")))


ORACLE["load_insert_if_absent"] = O.with_views(
    "SELECT 1 AS _",
).replace("\nSELECT 1 AS _", "") + LOAD_CTES + """
SELECT obs_id, md5(city || '|' || strftime(recorded_at, '%Y-%m-%d %H:%M:%S')) AS id, city, recorded_at, 'A' AS load_batch FROM ta
UNION ALL
SELECT obs_id, md5(city || '|' || strftime(recorded_at, '%Y-%m-%d %H:%M:%S')) AS id, city, recorded_at, 'B' AS load_batch FROM tb
"""


@query("load_stats")
def q_load_stats(spark, sf):
    """inserted / skipped / failed of each of the two loads."""
    a, b = _load_batches(spark, sf)
    ca = load_op.classify(a, None)
    ins_a = ca.where(F.col("_load_status") == "inserted").drop("_load_status")
    cb = load_op.classify(b, ins_a)
    return load_op.stats_frame(ca).select(F.lit("A").alias("load_batch"), "*").unionByName(
        load_op.stats_frame(cb).select(F.lit("B").alias("load_batch"), "*")
    )


ORACLE["load_stats"] = O.with_views("SELECT 1 AS _").replace("\nSELECT 1 AS _", "") + LOAD_CTES + """
SELECT 'A' AS load_batch, (SELECT count(*) FROM ta) AS inserted,
       count(*) - (SELECT count(*) FROM ta) - count(*) FILTER (WHERE city IS NULL OR recorded_at IS NULL) AS skipped,
       count(*) FILTER (WHERE city IS NULL OR recorded_at IS NULL) AS failed
FROM ba
UNION ALL
SELECT 'B', (SELECT count(*) FROM tb),
       count(*) - (SELECT count(*) FROM tb) - count(*) FILTER (WHERE city IS NULL OR recorded_at IS NULL),
       count(*) FILTER (WHERE city IS NULL OR recorded_at IS NULL)
FROM tr
"""
