"""From raw documents to packed token sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``;
an empty table goes through all stages as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.llm import language, mixing, packing, quality, simhash
from wxspark.llm.common import read, written

TOKENIZER, END_ID = "byte_bpe_50k.json", 0


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _aside(docs: DataFrame, judge, keep: str) -> DataFrame:
    """Rows that ``judge`` keeps, with their own columns even where it computes some of the
    same names: those ride along in a struct."""
    ride = docs.select(F.struct(*_columns(docs)).alias("__wx_row"), *[F.col(c) for c in ("doc_id", "text", "lang", "source")])
    return judge(ride).filter(keep).select("__wx_row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _aside(docs, lambda d: quality.quality_rules(d, carry=["__wx_row"]), "kept")


def _named(found: DataFrame) -> DataFrame:
    row = F.col("__wx_row")
    return found.withColumn("__wx_row", row.withField("lang", F.coalesce(row["lang"], F.col("lang_pred"))))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a language's centroid; ``lang`` where it is null is set
    to the language found."""
    model = language.learn(docs.filter(~language.held_out(4, 2)))
    kept = _aside(docs, lambda d: _named(language.identify(d, model)), "not rejected")
    return kept.select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return simhash.one_of_each(docs).select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    times = lambda d: mixing.mix_sources(d).withColumn("__wx_pass", F.explode(F.sequence(F.lit(1), F.greatest("passes", F.lit(1)))))
    return _aside(docs, times, "passes > 0").select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece, with its ids and its place."""
    import public_tokenizers

    out = packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: Learned centroids, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each but the last written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
