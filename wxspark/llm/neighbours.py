"""Quality classification by nearest-neighbour voting in a latent-semantic space.

A text is a vector of hashed n-grams of its shape (letters by case, digits, other
characters as they are) and of how much it repeats itself, projected onto the leading
singular vectors of the labelled texts. Every text is compared, in blocks, with every
labelled vector; the labels of the nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import read, without, written
from wxspark.llm.language import held_out
from wxspark.llm.ngrams import TEXTS, hashed_counts, unit

DIMS, SIZES, LATENT, NEIGHBOURS = 1024, (1, 2, 3), 48, 15
#: Labelled documents that vote, at most: those of the smallest hash of doc_id.
SAMPLE = 4000
#: A vote's weight is its similarity to this power.
POWER = 8
#: Weight of each measure of repetition beside the n-grams, and its steps.
REPEAT_WEIGHT, STEPS = 0.45, 8
SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))


def repetition(text: str) -> list[float]:
    """Shares: repeated words, words like the one before, repeated word triples, repeated
    lines; and the inverse of the number of words."""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = len(words)
    if not n:
        return [0.0, 0.0, 0.0, 0.0, 1.0]
    triples = max(0, n - 2)
    return [
        1 - len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / triples if triples else 0.0,
        1 - len(set(lines)) / len(lines),
        1 / n,
    ]


def features(texts: list[str | None]) -> np.ndarray:
    texts = [t or "" for t in texts]
    shapes = [t.encode("utf-8", "surrogatepass").translate(SHAPE) for t in texts]
    grams = unit(np.log1p(hashed_counts(shapes, DIMS, SIZES)))
    shares = np.array([repetition(t) for t in texts], np.float32).reshape(len(texts), -1)
    # A share of x lights the steps up to x, so that near shares have near vectors.
    steps = shares[:, :, None] > (np.arange(STEPS) / STEPS)[None, None, :] ** 2 + 0.02
    return np.hstack([grams, REPEAT_WEIGHT * steps.reshape(len(texts), -1).astype(np.float32) / np.sqrt(STEPS), np.full((len(texts), 1), 0.1, np.float32)])


WIDTH = DIMS + 5 * STEPS + 1


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, text, ``label``) of at most ``sample`` documents, those of the smallest hash
    of doc_id; rows that agree in id, text and label are one. Ids and hashes are chosen
    first, so an id that repeats moves no more texts than ``sample``."""
    order = [F.xxhash64("doc_id"), "doc_id", label]
    known = labels.select("doc_id", label).filter(F.col(label).isin(0, 1)).distinct().orderBy(*order).limit(sample)
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    chosen = keyed.select("doc_id", "key").join(known, "doc_id").distinct().orderBy(*order, "key").limit(sample)
    return keyed.join(written(chosen, "labelled"), ["doc_id", "key"]).dropDuplicates(["doc_id", "key", label]).drop("key")


def learn(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> dict:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, ``label`` 0 or 1); rows
    without a label teach nothing, repeated rows once.

    At most ``sample`` documents (``labelled``) are made vectors on the executors; only
    their features reach the driver. ``axes`` has LATENT singular vectors.
    """
    some = labelled(docs, labels, label, sample)

    def rows(batches):
        for b in batches:
            for at in range(0, len(b), TEXTS):
                part = b.iloc[at : at + TEXTS]
                yield pd.DataFrame({"doc_id": part["doc_id"], "y": part[label], "x": [v.astype(np.float16).tobytes() for v in features(part["text"].tolist())]})

    found = some.select("doc_id", "text", label).mapInPandas(rows, "doc_id bigint, y int, x binary").toPandas().sort_values(["doc_id", "x"])
    x = np.array([np.frombuffer(v, np.float16) for v in found["x"]], np.float32).reshape(-1, WIDTH)
    if not len(x):
        return {"axes": np.zeros((WIDTH, 1), np.float32), "points": np.zeros((0, 1), np.float32), "labels": np.zeros(0)}
    values, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = axes[:, ::-1][:, : min(LATENT, len(x))].astype(np.float32)
    # The first axis is what all texts share; without their mean, cosines tell them apart.
    centre = (x @ axes).mean(0)
    return {"axes": axes, "centre": centre, "points": unit(x @ axes - centre), "labels": found["y"].to_numpy(float)}


def classify(docs: DataFrame, model: dict, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``docs`` (text, ...) with score, 0 to 1: the weighted share of label 1 among the
    nearest labelled vectors. Null is an empty text, which has a vector like any other.
    Without labelled rows all scores are 0.5. Other columns stay, save one named score."""
    axes, points, labels, centre = model["axes"], model["points"], model["labels"], model.get("centre", 0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = np.full(len(texts), 0.5)
            for at in range(0, len(texts), TEXTS) if len(points) else ():
                near = unit(features(texts.iloc[at : at + TEXTS].tolist()) @ axes - centre) @ points.T
                k = min(neighbours, len(points))
                best = np.argpartition(near, -k, axis=1)[:, -k:]
                weight = np.clip(np.take_along_axis(near, best, 1), 1e-6, 1) ** POWER
                out[at : at + TEXTS] = np.clip((weight * labels[best]).sum(1) / weight.sum(1), 0, 1)
            yield pd.Series(out)

    return without(docs, "score").withColumn("score", score.asNondeterministic()("text"))


def op9_neighbours(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, read(spark, sf_dir, "labels").filter(~held_out(5, 0)), "quality")
    scored = classify(docs, model)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score").withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
