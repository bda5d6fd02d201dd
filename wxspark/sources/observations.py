"""The ``obs`` observation view, derived by Spark from the given ``events`` table.

Every event becomes one weather observation of the city named by the customer's nation.
The mapping deliberately plants the faults the quality engine must find (NULL and
out-of-range measurements, short names, many readings per (city, hour)), so the view
grows with ``events`` and exercises every rule at every scale.

Definition (the DuckDB oracle builds the identical view in ``plans.oracle``):

* ``k``  = integer ``props.k``; ``t0`` = ((round(value*100) as bigint) % 6000 - 1500) / 100
* ``wc`` = NULL for event_id % 101 = 0, else by event type (click Clear, view Clouds,
  purchase Rain, signup Haze, other Thunderstorm)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.sources.tables import dealt, read_table

# Event type -> weather condition used by the derived view (first match wins).
EVENT_CONDITIONS = (
    ("click", "Clear"),
    ("view", "Clouds"),
    ("purchase", "Rain"),
    ("signup", "Haze"),
)
OTHER_CONDITION = "Thunderstorm"


def _condition_sql() -> str:
    cases = " ".join(f"WHEN event_type = '{t}' THEN '{c}'" for t, c in EVENT_CONDITIONS)
    return f"CASE WHEN event_id % 101 = 0 THEN NULL {cases} ELSE '{OTHER_CONDITION}' END"


# The projection is written as SQL expressions: one parse in the JVM instead of hundreds
# of client round trips for an equivalent Column tree (same plan either way).
DERIVED_SQL = (
    "try_cast(get_json_object(props, '$.k') AS INT) AS k",
    "CAST((CAST(round(value * 100D) AS BIGINT) % 6000) - 1500 AS DOUBLE) / 100D AS t0",
    f"{_condition_sql()} AS wc",
)
OBS_SQL = (
    "event_id AS obs_id",
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'X' ELSE n_name END AS city",
    "concat('R', CAST(n_regionkey AS STRING)) AS country",
    "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 61 = 0 THEN 999.9D ELSE t0 END AS temperature_c",
    "t0 + CAST(k % 5 - 2 AS DOUBLE) AS feels_like_c",
    "t0 - CAST(k % 4 AS DOUBLE) AS temp_min_c",
    "t0 + CAST(k % 4 AS DOUBLE) AS temp_max_c",
    "CAST(CASE WHEN event_id % 71 = 0 THEN 130 ELSE k END AS INT) AS humidity_pct",
    "CAST(CASE WHEN event_id % 83 = 0 THEN 1200 ELSE 990 + event_id % 45 END AS INT) AS pressure_hpa",
    "CAST(event_id * 7 % 250 AS DOUBLE) / 10D AS wind_speed_mps",
    "CAST(event_id * 13 % 360 AS INT) AS wind_direction_deg",
    "wc AS weather_condition",
    "concat(lower(wc), ' sky') AS weather_description",
    "CAST(event_id % 11 * 1000 AS INT) AS visibility_m",
    "CAST(k * 3 % 101 AS INT) AS cloudiness_pct",
    "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS recorded_at",
    "CAST(date_trunc('SECOND', ts) AS TIMESTAMP_NTZ) AS extracted_at",
    "ts AS inserted_at",
)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw (unvalidated) observation frame with ``obs_id`` as ingest order."""
    events = dealt(
        read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"), "event_id"
    )
    # Dimension tables: one row per customer / nation; Catalyst prunes them to the
    # referenced columns and broadcasts them only when their size is under the
    # broadcast threshold (otherwise they are shuffled like any join side).
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    e = events.join(customer, events.user_id == customer.c_custkey, "left").join(
        nation, F.col("c_nationkey") == nation.n_nationkey, "left"
    )
    return e.selectExpr("*", *DERIVED_SQL).selectExpr(*OBS_SQL)
