"""Line dedup over documents: a line that several documents hold stays in one of them
(DataFrame functions only).

Lines are exploded, normalised (blanks stripped at both ends, A-Z lower-cased) and hashed to
128 bits; distinct documents are counted per hash; hashes at or over the threshold, with the
smallest doc_id that holds them, are written as a table. Lines that meet it in another
document give up their positions, and each text is put together again from the others.
Only hashes and positions of lines are shuffled up to then; a line that a third of all
documents hold is counted per task before the shuffle and is one row of the table.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import read, without, written

LEAST_LENGTH, LEAST_DOCUMENTS = 10, 2
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: str) -> Column:
    """The line without blanks at its ends, A-Z (and no other letter) lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def shared_lines(lines: DataFrame, least_documents: int) -> DataFrame:
    """(__wx_h, __wx_g, doc_id) to the hashes that so many documents hold, with the smallest
    doc_id, __wx_first. Null is an id like others, the last."""
    held = lines.select("__wx_h", "__wx_g", "doc_id").distinct()
    counted = held.groupBy("__wx_h", "__wx_g").agg(F.count("*").alias("n"), F.min("doc_id").alias("__wx_first"))
    return counted.filter(F.col("n") >= least_documents).drop("n")


def dedup_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` (doc_id, text, anything else) with n_lines, n_dropped and kept (text).

    Keys of at least ``least_length`` code points that at least ``least_documents``
    documents hold lose all their lines except in the document of the smallest doc_id;
    there all of them stay, repeats too. Null text is empty, and an empty text is one empty
    line. Rows of one doc_id are one document, whatever their texts; a null doc_id is an id
    too, the last. Input columns with the names of computed ones are replaced; an empty
    table gives an empty one.
    """
    d = without(docs, "n_lines", "n_dropped", "kept").withColumn("__wx_t", F.coalesce("text", F.lit("")))
    d = d.withColumn("__wx_row", F.xxhash64("__wx_t"))
    split = F.split("__wx_t", "\n")
    lines = d.select("doc_id", "__wx_row", F.posexplode(split).alias("__wx_at", "line"))
    lines = lines.withColumn("key", line_key("line")).filter(F.length("key") >= least_length)
    lines = lines.select("doc_id", "__wx_row", "__wx_at", F.xxhash64("key").alias("__wx_h"), F.xxhash64(F.lit("line"), "key").alias("__wx_g"))
    shared = written(shared_lines(lines, least_documents), "shared-lines")
    drops = lines.join(shared, ["__wx_h", "__wx_g"]).filter(~F.col("doc_id").eqNullSafe(F.col("__wx_first")))
    # Rows of one id and text have the same positions: a set holds them once.
    drops = drops.groupBy(F.col("doc_id").alias("__wx_doc"), F.col("__wx_row").alias("__wx_of")).agg(F.collect_set("__wx_at").alias("__wx_drop"))
    both = d.join(drops, d["doc_id"].eqNullSafe(drops["__wx_doc"]) & (d["__wx_row"] == drops["__wx_of"]), "left")
    both = both.withColumn("__wx_l", split)
    n = F.size("__wx_l")
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__wx_drop"))
    kept = F.array_join(F.transform(left, lambda i: F.get("__wx_l", i)), "\n")
    return both.select(
        *[F.col(f"`{c}`") for c in without(docs, "n_lines", "n_dropped", "kept").columns],
        n.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__wx_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("__wx_drop").isNull(), F.col("__wx_t")).otherwise(kept).alias("kept"),
    )


def op11_lines(spark, sf_dir: str) -> DataFrame:
    """Digests of the kept texts; null and empty texts, ties, repeated ids and empty tables
    as in ``dedup_lines``."""
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
s AS (
  SELECT k, min(doc_id) AS first FROM k WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 2),
m AS (SELECT k.*, s.k IS NOT NULL AND k.doc_id IS DISTINCT FROM s.first AS gone FROM k LEFT JOIN s USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
