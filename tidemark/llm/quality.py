"""Supervised subword embeddings as a quality classifier, trained with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import code_points, ngram_buckets, word_buckets
from tidemark.llm.shared import ship

NGRAMS = (3, 4)
ROW_STEPS = 10  # a row's share of a text is small, so its steps are longer
LAGS = (1, 2, 3)  # how far back the other word of a pair stands


@dataclass(frozen=True)
class Settings:
    """``examples`` bounds the labelled rows that are learned from, half of it for each
    class; a row gives at most ``buckets`` numbers to the driver."""

    examples: int = 2000
    buckets: int = 1 << 17
    dims: int = 8
    epochs: int = 6
    rate: float = 1.0
    seed: int = 7


def features(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of all words, word pairs and character n-grams of the whole text. Equal
    words make the same pair whatever they are, so repetition has a vector too."""
    points = code_points(text or "")
    words = word_buckets(points, buckets)
    pairs = [(words[lag:] ^ words[:-lag]) * 5 + lag for lag in LAGS]
    pairs = [p % buckets for p in pairs]
    return np.concatenate([words, *pairs, *[ngram_buckets(points, n, buckets) for n in NGRAMS]])


@dataclass
class Model:
    """Vectors per bucket, averaged over a text, then a softmax over the two classes.
    As averaging is linear, a bucket's vector counts by one number, its ``weight``."""

    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        found = features(text, len(self.weight))
        logit = self.bias + (float(self.weight[found].mean(dtype=np.float64)) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], prior: float, s: Settings) -> Model:
    """Stochastic gradient descent over (buckets, shares, label); ``prior`` is the
    share of label 1 among all labels, which the sample by halves does not show."""
    rng = np.random.default_rng(s.seed)
    table = rng.uniform(-1 / s.dims, 1 / s.dims, (s.buckets, s.dims))
    out, bias = np.zeros((s.dims, 2)), np.zeros(2)
    ones = sum(y for _, _, y in examples)
    share = {1: ones / max(1, len(examples)), 0: 1 - ones / max(1, len(examples))}
    step, steps = 0, s.epochs * len(examples)
    for _ in range(s.epochs):
        for n in rng.permutation(len(examples)):
            own, shares, y = examples[n]
            hidden = shares @ table[own]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            rate = s.rate * (1 - step / steps)
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            table[own] -= ROW_STEPS * rate * shares[:, None] * back
            step += 1
    weight = table @ (out[:, 1] - out[:, 0])
    shift = 0.0
    if 0 < ones < len(examples):
        # back from the sample's balance to that of the labels
        shift = float(np.log(prior / (1 - prior)) - np.log(share[1] / share[0]))
    return Model(weight.astype(np.float32), float(bias[1] - bias[0]) + shift)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns ``quality`` (0 or 1) of ``labels`` (doc_id, quality) from the texts of
    ``docs``. Of each class the ``examples / 2`` labels whose doc_ids hash lowest are
    used. Labels that are NULL or have no document are left out; without any, all
    texts score 0.5, and with one class only its share of the model is learned.
    """
    ship(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_y")
    )
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    half = settings.examples // 2
    order = [F.xxhash64("_id"), F.col("_id")]
    some = known.where("_y = 0").orderBy(*order).limit(half).union(known.where("_y = 1").orderBy(*order).limit(half))
    # at most `examples` rows
    found = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(some), "_id")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [np.unique(features(t, settings.buckets), return_counts=True) for t in batch["text"]]
            # as bytes, which reach the driver without an object per number
            own, n = ([r[k].astype("<i4").tobytes() for r in rows] for k in (0, 1))
            yield pd.DataFrame({"_id": batch["_id"], "_y": batch["_y"], "own": own, "n": n})

    rows = found.mapInPandas(counted, "_id long, _y int, own binary, n binary")
    # repeated documents do not raise the bound
    rows = rows.orderBy(F.xxhash64("_id"), "_id", "_y", F.octet_length("own")).limit(settings.examples).toPandas()
    examples = []
    for own, n, y in zip(rows["own"], rows["n"], rows["_y"], strict=True):
        if len(own):
            counts_of = np.frombuffer(n, "<i4")
            examples.append((np.frombuffer(own, "<i4"), (counts_of / counts_of.sum()).astype(np.float32), int(y)))
    return train(examples, counts.get(1, 0) / max(1, sum(counts.values())), settings)


def score(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return of(text)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``quality_score``: how likely label 1 is, from 0
    to 1, judged by the whole text alone. NULL and empty texts get the score of a text
    that says nothing, repeated rows the same score, an empty table none. A column of
    that name is replaced. The model is a number per bucket; texts are not shuffled."""
    model = fit(docs, labels, settings)
    return docs.withColumn("quality_score", score(F.col("text"), model))
