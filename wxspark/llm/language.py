"""Language identification by nearest centroids.

A text is a vector of hashed letter n-grams, log counts times inverse document frequency,
of length one. Each language has several centroids, the means of spherical k-means over a
sample of its documents. A text has the language of the centroid of the largest cosine;
it is rejected where that is under the centroid's limit, a share of what the sample's
least typical documents reach.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import read, without, written
from wxspark.llm.ngrams import TEXTS, hashed_counts, unit

DIMS, SIZES, CENTROIDS = 4096, (1, 2, 3), 4
#: Documents of a language that its centroids are learned from, at most: those of the
#: smallest hash of doc_id.
SAMPLE = 400
#: Parts that the sample of a language is first chosen in.
PARTS = 64
#: A centroid's limit: this share of the cosine that all but 1 % of its sample reach.
REJECT_SHARE = 0.5
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    return NO_LETTERS.sub(" ", (text or "").lower()).strip().encode("utf-8", "surrogatepass")


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(hashed_counts([letters(t) for t in texts], DIMS, SIZES)) * idf)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of every hash value over all of ``docs`` (text)."""

    def count(batches):
        seen, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for at in range(0, len(b), TEXTS):
                texts = b.column(0).slice(at, TEXTS).to_pylist()
                seen += (hashed_counts([letters(t) for t in texts], DIMS, SIZES) > 0).sum(0)
                n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1), pa.int32()), pa.array(np.append(seen, n), pa.int64())], ["k", "n"])

    sums = docs.select("text").mapInArrow(count, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    n = np.zeros(DIMS + 1)
    for r in sums.collect():  # DIMS + 1 rows
        n[r["k"]] = r["n"]
    return (1 + np.log((1 + n[-1]) / (1 + n[:-1]))).astype(np.float32)


def clustered(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from far-apart starts; the same for the same rows."""
    centres = unit(x.mean(0, keepdims=True))
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(1))]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        centres = unit(np.vstack([x[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centres)]))
    return centres.astype(np.float32)


def first_documents(docs: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` documents of each language in ``docs`` (doc_id, text, lang) of smallest
    hash of doc_id; rows that agree in id, language and text are one document.

    They are chosen in PARTS parts of a language and then among PARTS * sample at most, by
    ids and hashes; only the texts of those chosen move.
    """
    keyed = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("key"))
    order = [F.xxhash64("doc_id"), "doc_id", "key"]
    ids = keyed.select("lang", "doc_id", "key").distinct().withColumn("part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("n") <= sample)
    ids = written(ids.select("lang", F.col("doc_id").alias("id"), "key"), "language-sample")
    same = (keyed["lang"] == ids["lang"]) & keyed["doc_id"].eqNullSafe(ids["id"]) & (keyed["key"] == ids["key"])
    return keyed.join(ids, same, "left_semi").dropDuplicates(["doc_id", "lang", "key"]).drop("key")


def learn(docs: DataFrame, k: int = CENTROIDS, sample: int = SAMPLE) -> dict:
    """A model from ``docs`` (doc_id, text, lang); rows of null text or lang teach nothing.

    Document frequencies come from all of these rows, centroids from ``sample`` documents
    of each language (``first_documents``). The model holds ``k`` centroids of DIMS numbers
    for each language.
    """
    docs = docs.filter("text is not null and lang is not null").select("doc_id", "text", "lang")
    idf = document_frequencies(docs)
    some = first_documents(docs, sample)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        x = vectors(pdf["text"].tolist(), idf)
        x = x[x.any(1)]
        if not len(x):
            return pd.DataFrame({"lang": [], "centre": [], "least": []})
        centres = clustered(x, k)
        near = (x @ centres.T).max(1)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": [c.tobytes() for c in centres], "least": float(np.quantile(near, 0.01)) * REJECT_SHARE})

    rows = sorted(some.groupBy("lang").applyInPandas(fit, "lang string, centre binary, least double").collect())
    return {
        "idf": idf,
        "langs": [r["lang"] for r in rows],
        "centres": np.array([np.frombuffer(r["centre"], np.float32) for r in rows]).reshape(-1, DIMS),
        "least": np.array([r["least"] for r in rows]),
    }


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` (text, ...) with lang_pred, score (cosine, 0 to 1) and rejected.

    Null texts and texts without letters are ``und``, with score 0, and rejected, and so
    are all texts where the model has no language. Other columns stay; those with the
    names of computed ones are replaced.
    """
    idf, langs, centres, least = model["idf"], np.array(model["langs"], object), model["centres"], model["least"]

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [pd.DataFrame({"lang_pred": pd.Series([], dtype=object), "score": pd.Series([], dtype=float), "rejected": pd.Series([], dtype=bool)})]
            for at in range(0, len(texts), TEXTS):
                x = vectors(texts.iloc[at : at + TEXTS].tolist(), idf)
                known = x.any(1) & (len(langs) > 0)
                pred, score, rejected = np.full(len(x), UNKNOWN, object), np.zeros(len(x)), np.ones(len(x), bool)
                if len(langs):
                    near = x @ centres.T
                    best = near.argmax(1)
                    pred[known] = langs[best[known]]
                    score[known] = np.clip(near.max(1)[known], 0, 1)
                    rejected[known] = score[known] < least[best[known]]
                found.append(pd.DataFrame({"lang_pred": pred, "score": score, "rejected": rejected}))
            yield pd.concat(found, ignore_index=True)

    docs = without(docs, "lang_pred", "score", "rejected")
    return docs.withColumn("__wx_p", predict.asNondeterministic()("text")).select(*[f"`{c}`" for c in docs.columns], "__wx_p.*")


def held_out(mod: int, of: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod == of


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn(docs.select("doc_id", "text", "lang").filter(~held_out(4, 2)))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")
