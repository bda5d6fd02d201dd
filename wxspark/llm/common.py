"""Helpers that several operators share."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wxspark.session import checkpoint_dir
from wxspark.sources.tables import table_path

#: A word: code points other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def written(df: DataFrame, name: str, by: str | None = None, **options: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, in folders ``by`` a column:
    cuts the lineage, and a lost executor costs nothing that has been written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    writer = df.write.options(**options)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of these names, whatever their case: computed columns
    replace input columns of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def buckets_for(n_rows: int) -> int:
    """Square root of the rows: as many buckets as rows in a bucket."""
    return max(1, math.isqrt(max(0, n_rows)) + 1)


def hex_bucket(order: str, buckets: int) -> Column:
    """Bucket of a hexadecimal digest, ascending with the digest."""
    return F.shiftright(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint") * F.lit(buckets), 32)


def running_total(df: DataFrame, keys: list[str], order: str, ties: list[str], value: str, out: str, buckets: int, measures: DataFrame | None = None) -> DataFrame:
    """Adds ``out``: the inclusive running total of ``value`` within ``keys``, by the hex
    digest ``order`` and then ``ties``. ``measures``, if any, are the same rows with these
    columns alone, from which totals are cheaper.

    Two levels, so that a hot key is no single task: totals of (key, digest range) are
    summed over the ranges, and rows run only within their range. ``keys`` must not be
    null. Rows that agree in ``order`` and ``ties`` follow each other in any order.
    """
    d = df.withColumn("__wx_b", hex_bucket(order, buckets))
    before = Window.partitionBy(*keys).orderBy("__wx_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        (d if measures is None else measures.withColumn("__wx_b", hex_bucket(order, buckets)))
        .groupBy(*keys, "__wx_b")
        .agg(F.sum(value).alias("__wx_s"))
        .select(*keys, "__wx_b", F.coalesce(F.sum("__wx_s").over(before), F.lit(0)).alias("__wx_off"))
    )
    inside = Window.partitionBy(*keys, "__wx_b").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return (
        d.withColumn("__wx_in", F.sum(value).over(inside))
        .join(offsets, [*keys, "__wx_b"])
        .withColumn(out, F.col("__wx_off") + F.col("__wx_in"))
        .drop("__wx_b", "__wx_in", "__wx_off")
    )
