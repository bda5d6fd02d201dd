"""SparkSession construction and the few session-level settings the engine relies on.

The engine never creates its own cluster settings when it is handed a session; it only
pins what correctness needs (UTC session zone) and reads the shared checkpoint folder
from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session used by the engine must have for correct results.
REQUIRED_CONF = {
    # All timestamps are naive UTC (TIMESTAMP_NTZ); LTZ intermediates must not shift.
    "spark.sql.session.timeZone": "UTC",
    # Parquet written by pandas carries naive timestamps: keep them NTZ.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}

# Defaults for sessions the engine builds itself (tests, bench, CLI).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE may merge small shuffle partitions, but not below 256 KB each: the stages after
    # the duplicate join are CPU-bound (flags, heat index), so a few MB of shuffle output
    # should still spread over the cores instead of collapsing into one or two tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark's call-site capture costs ~10 JVM round trips per Column function call
    # (F.col, F.when, ...): most of the client-side plan construction time. Errors then
    # carry no Python call site. Sessions handed to the engine keep their own setting.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Deal the derived view's scan out to so many partitions, where set: a caller's choice for
#: inputs of few row groups. Unset, the scan is as the files are split.
SCAN_PARTITIONS = "wxspark.scan.partitions"


def _threads(master: str) -> str:
    found = re.search(r"\[(\d+)", master)
    return found[1] if found else str(os.cpu_count() or 1)


def build_session(master: str | None = None, app_name: str = "wxspark", **conf: str) -> SparkSession:
    """Create (or reuse) a session; one with an own ``master`` gets the local defaults, and
    extra ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    defaults = {}
    if master:
        # An own local session. Without a master this is a submitted run, whose settings
        # (shuffle partitions, adaptive execution, ...) are the cluster's.
        builder = builder.master(master)
        defaults = DEFAULT_CONF | {SCAN_PARTITIONS: _threads(master)}
    for key, value in {**defaults, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings correctness depends on to a caller-supplied session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster this setting must point at shared storage and is only read here; a
    cluster session without it is an error (a driver-local folder is not visible to the
    executors and does not survive the driver). Only a local-mode session (tests, bench),
    whose executor is the driver itself, gets a private folder where none is set.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at shared storage (e.g. the cluster's "
            "distributed file system) before running jobs that cut lineage"
        )
    registered = context._jsc.sc().getCheckpointDir()
    registered = registered.get() if registered.isDefined() else None
    if not registered:
        configured = configured or tempfile.mkdtemp(prefix="wxspark-ckpt-")
        context.setCheckpointDir(configured)
    return configured or registered


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", name)
