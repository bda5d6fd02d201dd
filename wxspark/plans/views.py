"""Shared lazy views over the given tables: raw observations -> transformed -> validated
-> clean -> stored. Each registered query starts from one of these, so the whole chain is
one Catalyst plan per query (no intermediate materialisation, no driver round trip).

The chain is built once per session and input folder and then reused, as a temp view
would be: a view is a lazy plan, not data, so reuse only saves the client-side plan
construction (hundreds of JVM calls per view). Views are kept under the size, number and
time of the input files, so changed files give new views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.operators import quality, transform
from wxspark.sources import raw_json
from wxspark.sources.observations import observations
from wxspark.sources.tables import table_path

_CHAIN: dict[tuple, object] = {}


def _listing(spark: SparkSession, sf_dir: str) -> tuple:
    """Bytes, files and time of change of each input table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in ("events", "customer", "nation"):
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(conf)
        size = fs.getContentSummary(path)
        found.append((size.getLength(), size.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(found)


def _memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, _listing(spark, sf_dir), name)
    hit = _CHAIN.get(key)
    if hit is None:
        hit = _CHAIN[key] = build()
    return hit


def refresh() -> None:
    """Forget every built view (the next use re-lists the input files)."""
    _CHAIN.clear()


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "obs", lambda: observations(spark, sf_dir))


def transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with ``heat_index_c`` and ``comfort_level`` (batch profile)."""
    return _memo(spark, sf_dir, "transformed", lambda: transform.add_derived(obs(spark, sf_dir)))


def validation(spark: SparkSession, sf_dir: str) -> quality.Validation:
    return _memo(spark, sf_dir, "validation", lambda: quality.validate(transformed(spark, sf_dir)))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "clean", lambda: validation(spark, sf_dir).clean)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the keyed load leaves in an empty table for the clean rows (keys are unique
    after validation, so insert-if-absent keeps every clean row)."""
    return _memo(spark, sf_dir, "stored", lambda: transform.to_stored(clean(spark, sf_dir)))


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation as the raw JSON document the provider would have sent."""

    def build() -> DataFrame:
        o = obs(spark, sf_dir)
        return o.select("obs_id", "inserted_at", raw_json.observation_to_raw(o).alias("doc"))

    return _memo(spark, sf_dir, "raw_docs", build)


def parsed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_docs`` parsed back with the tolerant RAW schema (one parse per document)."""
    return _memo(
        spark,
        sf_dir,
        "parsed_docs",
        lambda: raw_json.parse_docs(raw_docs(spark, sf_dir), F.col("doc"), keep=("obs_id", "inserted_at")),
    )
