"""File sinks: raw landing JSON, processed CSV, validation report JSON, report exports.

Everything is written by Spark tasks in parallel; only the tiny per-report outputs are
coalesced to a single file, and only after the (distributed) aggregation produced them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F



def write_landing(docs: DataFrame, path: str, ingest_ts_col: str = "ingest_ts") -> None:
    """Append raw documents (column ``doc``) as JSON lines, one folder per ingest date."""
    (
        docs.select(F.col("doc").alias("value"), F.to_date(ingest_ts_col).alias("ingest_date"))
        .write.mode("append")
        .partitionBy("ingest_date")
        .text(path)
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def export_table(df: DataFrame, path: str, order: list) -> None:
    """Whole table as CSV files that follow each other in ``order`` (a total order): the sort
    deals ranges to tasks, each writes its own, none holds the table. ``path/rows`` has the
    rows without headers, ``path/header`` the one line of column names, so
    ``cat header/part-* rows/part-*`` is the table as one CSV."""
    df.orderBy(*order).write.mode("overwrite").option("header", False).csv(os.path.join(path, "rows"))
    names = df.sparkSession.createDataFrame([(",".join(df.columns),)], "value string")
    names.coalesce(1).write.mode("overwrite").text(os.path.join(path, "header"))


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def export_reports(reports: dict[str, DataFrame], out_dir: str, run_ts=None, total_records: DataFrame | None = None) -> list[str]:
    """One folder per non-empty report (parquet + single-file CSV) and a ``metadata`` row.

    Report names become folder names (spaces -> underscores, lower case). Each report is
    computed once: its (small, already aggregated and sorted) rows are written as one
    parquet file, in order, while its row count is observed on the same pass; the CSV is
    then copied from that file instead of recomputing the report from the source table.
    An empty report leaves an empty parquet folder and is not listed.
    """
    written = []
    for name, df in reports.items():
        slug = name.lower().replace(" ", "_")
        pq = os.path.join(out_dir, slug, "parquet")
        rows = Observation(f"rows_{slug}")
        df.coalesce(1).observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(pq)
        if int(rows.get.get("n", 0)) == 0:
            continue
        write_csv(df.sparkSession.read.parquet(pq), os.path.join(out_dir, slug, "csv"), single_file=True)
        written.append(slug)
    if total_records is not None:
        meta = total_records
        if run_ts is not None:
            meta = meta.select(F.lit(run_ts).cast("timestamp_ntz").alias("generated_at"), "*")
        write_json(meta, os.path.join(out_dir, "metadata"))
    return written


def run_stamp_literal(ts) -> str:
    """``yyyyMMdd_HHmmss`` for a Python datetime (run ids and file stamps)."""
    return ts.strftime("%Y%m%d_%H%M%S")


__all__ = ["write_landing", "write_csv", "export_table", "write_json", "export_reports", "run_stamp_literal"]
