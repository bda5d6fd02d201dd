"""Independent ANSI-SQL (DuckDB dialect) twins of the registered queries.

The SQL restates each query's meaning from scratch over the raw tables; it shares no
code with the Spark side. Common building blocks are CTEs prepended to every query:

``ev`` (events + customer + nation), ``obs`` (raw observations), ``tr`` (+ heat index,
comfort), ``flagged`` (+ rule flags, via window functions), ``clean``, ``stored``.
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format

HEAT_INDEX_SQL = (
    "round_even(("
    "CAST(-8.78469475556 AS DOUBLE)"
    " + CAST(1.61139411 AS DOUBLE) * {t}"
    " + CAST(2.33854883889 AS DOUBLE) * {h}"
    " - CAST(0.14611605 AS DOUBLE) * {t} * {h}"
    " - CAST(0.012308094 AS DOUBLE) * ({t} * {t})"
    " - CAST(0.016424828 AS DOUBLE) * ({h} * {h})"
    " + CAST(0.002211732 AS DOUBLE) * ({t} * {t}) * {h}"
    " + CAST(0.00072546 AS DOUBLE) * {t} * ({h} * {h})"
    " - CAST(0.000003582 AS DOUBLE) * ({t} * {t}) * ({h} * {h})"
    ") * CAST(10 AS DOUBLE), 0) / CAST(10 AS DOUBLE)"
)


def heat_index_sql(t: str, h: str) -> str:
    return HEAT_INDEX_SQL.format(t=f"CAST({t} AS DOUBLE)", h=f"CAST({h} AS DOUBLE)")


def comfort_sql(t: str, profile: str = "batch") -> str:
    b = {"batch": (10, 20, 28, 35), "live": (10, 18, 26, 33)}[profile]
    null = "'Unknown'" if profile == "batch" else "NULL"
    return (
        f"CASE WHEN {t} IS NULL THEN {null} WHEN {t} < {b[0]} THEN 'Cold' WHEN {t} < {b[1]} THEN 'Cool' "
        f"WHEN {t} < {b[2]} THEN 'Comfortable' WHEN {t} < {b[3]} THEN 'Warm' ELSE 'Hot' END"
    )


def rnd(x: str, digits: int) -> str:
    """numpy-style rounding: half-even on the scaled double."""
    s = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(round_even(({x}) * {s}, 0) / {s})"


EV = """
ev AS (
  SELECT e.event_id, e.ts, e.event_type, e.value, n.n_name, n.n_regionkey,
         TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         CAST(CAST(round(e.value * 100) AS BIGINT) % 6000 - 1500 AS DOUBLE) / CAST(100 AS DOUBLE) AS t0,
         CASE WHEN e.event_id % 101 = 0 THEN NULL
              WHEN e.event_type = 'click' THEN 'Clear'
              WHEN e.event_type = 'view' THEN 'Clouds'
              WHEN e.event_type = 'purchase' THEN 'Rain'
              WHEN e.event_type = 'signup' THEN 'Haze'
              ELSE 'Thunderstorm' END AS wc
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

OBS = """
obs AS (
  SELECT event_id AS obs_id,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'X' ELSE n_name END AS city,
         'R' || CAST(n_regionkey AS VARCHAR) AS country,
         CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 61 = 0 THEN CAST(999.9 AS DOUBLE) ELSE t0 END AS temperature_c,
         t0 + CAST(k % 5 - 2 AS DOUBLE) AS feels_like_c,
         t0 - CAST(k % 4 AS DOUBLE) AS temp_min_c,
         t0 + CAST(k % 4 AS DOUBLE) AS temp_max_c,
         CAST(CASE WHEN event_id % 71 = 0 THEN 130 ELSE k END AS INTEGER) AS humidity_pct,
         CAST(CASE WHEN event_id % 83 = 0 THEN 1200 ELSE 990 + event_id % 45 END AS INTEGER) AS pressure_hpa,
         CAST(event_id * 7 % 250 AS DOUBLE) / CAST(10 AS DOUBLE) AS wind_speed_mps,
         CAST(event_id * 13 % 360 AS INTEGER) AS wind_direction_deg,
         wc AS weather_condition,
         lower(wc) || ' sky' AS weather_description,
         CAST(event_id % 11 * 1000 AS INTEGER) AS visibility_m,
         CAST(k * 3 % 101 AS INTEGER) AS cloudiness_pct,
         date_trunc('hour', ts) AS recorded_at,
         date_trunc('second', ts) AS extracted_at,
         ts AS inserted_at
  FROM ev
)"""

TR = f"""
tr AS (
  SELECT *, {heat_index_sql('temperature_c', 'humidity_pct')} AS heat_index_c,
         {comfort_sql('temperature_c')} AS comfort_level
  FROM obs
)"""

FLAGGED = """
flagged AS (
  SELECT *,
         (f_null_city OR f_null_temperature_c OR f_null_humidity_pct OR f_null_pressure_hpa
          OR f_null_weather_condition OR f_null_recorded_at OR f_range_temperature_c
          OR f_range_humidity_pct OR f_duplicate) AS critical
  FROM (
    SELECT *,
           city IS NULL AS f_null_city,
           temperature_c IS NULL AS f_null_temperature_c,
           humidity_pct IS NULL AS f_null_humidity_pct,
           pressure_hpa IS NULL AS f_null_pressure_hpa,
           weather_condition IS NULL AS f_null_weather_condition,
           recorded_at IS NULL AS f_null_recorded_at,
           coalesce(temperature_c < -90 OR temperature_c > 60, false) AS f_range_temperature_c,
           coalesce(humidity_pct < 0 OR humidity_pct > 100, false) AS f_range_humidity_pct,
           coalesce(pressure_hpa < 870 OR pressure_hpa > 1085, false) AS f_range_pressure_hpa,
           row_number() OVER (PARTITION BY city, recorded_at ORDER BY obs_id) > 1 AS f_duplicate,
           min(obs_id) OVER (PARTITION BY city, recorded_at) AS first_obs_id,
           coalesce(length(city) < 2, false) AS f_short_city
    FROM tr
  ) x
)"""

CLEAN = """
clean AS (
  SELECT obs_id, city, country, temperature_c, feels_like_c, temp_min_c, temp_max_c, humidity_pct,
         pressure_hpa, wind_speed_mps, wind_direction_deg, weather_condition, weather_description,
         visibility_m, cloudiness_pct, recorded_at, extracted_at, inserted_at, heat_index_c, comfort_level
  FROM flagged WHERE NOT critical
)"""

STORED = """
stored AS (
  SELECT md5(city || '|' || strftime(recorded_at, '%Y-%m-%d %H:%M:%S')) AS id, *,
         CAST(recorded_at AS DATE) AS date
  FROM clean
)"""

CTES = [EV, OBS, TR, FLAGGED, CLEAN, STORED]


def with_views(body: str) -> str:
    return "WITH " + ",".join(CTES) + "\n" + body
