"""Readers for the driver-supplied parquet tables (one file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from wxspark.session import SCAN_PARTITIONS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Declared schemas of the tables the engine reads (as stored in the parquet files).
# A declared schema skips footer sampling/inference at every read, and a file that
# drifts from it fails loudly instead of silently changing types.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to the partitions that the session's SCAN_PARTITIONS asks
    for; as its files are split where that is unset. Does not depend on the input's size."""
    partitions = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(partitions), *keys) if partitions else df
