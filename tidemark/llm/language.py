"""Language by the nearest of several centroids of TF-IDF character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.features import code_points, ngram_buckets
from tidemark.llm.shared import ship, stage

NGRAMS = (1, 2, 3)
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
PLACES = 1 << 40  # into which doc_ids are hashed


@dataclass(frozen=True)
class Settings:
    """``examples`` bounds the documents that are learned from, per language."""

    examples: int = 400
    buckets: int = 1 << 13
    centroids: int = 4
    rounds: int = 8
    seed: int = 8


def tf(text: str, buckets: int) -> np.ndarray:
    """Damped counts of the character n-grams of the whole lower-cased text."""
    points = code_points(f" {text.lower()} ")
    found = np.concatenate([ngram_buckets(points, n, buckets) for n in NGRAMS])
    return np.log1p(np.bincount(found, minlength=buckets)).astype(np.float32)


@dataclass
class Model:
    langs: list[str]  # per centroid
    centroids: np.ndarray  # rows of length one
    radius: np.ndarray  # cosine below which a centroid rejects
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, whether the text is too far from all that was learned)."""
        if text is None or not LETTER.search(text) or not self.langs:
            return UNKNOWN, 0.0, True
        x = tf(text, len(self.idf)) * self.idf
        near = self.centroids @ (x / (np.linalg.norm(x) or 1.0))
        best = int(np.argmax(near))
        return self.langs[best], float(np.clip(near[best], 0, 1)), bool(near[best] < self.radius[best])


def clustered(x: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows: (centroids, centroid of each row). Starts from
    rows that are far from each other; fewer rows or kinds of rows give fewer."""
    rng = np.random.default_rng(s.seed)
    start = [int(rng.integers(len(x)))]
    near = x @ x[start[0]]
    while len(start) < min(s.centroids, len(x)) and near.min() < 1 - 1e-6:
        start.append(int(near.argmin()))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(s.rounds):
        own = (x @ c.T).argmax(1)
        c = np.array([x[own == k].sum(0) if (own == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, (x @ c.T).argmax(1)


def fit(learned: DataFrame, s: Settings = Settings()) -> Model:
    """Learns from ``learned`` (doc_id, text, lang): of each language the ``examples``
    documents whose doc_ids hash lowest. Rows without language or letter are left out."""
    ship(learned.sparkSession)
    rows = learned.where("lang is not null and text is not null")
    rows = rows.select("lang", "text", F.xxhash64("doc_id").alias("_h"))
    # a hash cut leaves a few times as many rows as are wanted, however many there are,
    # so ranking a frequent language gathers little
    counts = stage(rows.groupBy("lang").count())  # a row per language
    place = F.pmod("_h", F.lit(PLACES)) / F.lit(float(PLACES))
    rows = rows.join(counts, "lang").where(place * F.col("count") < 4.0 * s.examples)
    within = Window.partitionBy("lang").orderBy(F.pmod("_h", F.lit(PLACES)), "_h", F.length("text"), "text")
    rows = rows.withColumn("_n", F.row_number().over(within)).where(F.col("_n") <= s.examples)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[bool(LETTER.search(t)) for t in batch["text"]]]
            if len(batch):
                vectors = [tf(t, s.buckets).tobytes() for t in batch["text"]]
                yield pd.DataFrame({"lang": batch["lang"].to_numpy(), "_n": batch["_n"].to_numpy(), "tf": vectors})

    found = rows.select("lang", "_n", "text").mapInPandas(counted, "lang string, _n int, tf binary").toPandas()
    found = found.sort_values(["lang", "_n"])
    if found.empty:
        return Model([], np.zeros((0, s.buckets)), np.zeros(0), np.zeros(s.buckets, np.float32))
    x = np.array([np.frombuffer(t, np.float32) for t in found["tf"]])
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x = x * idf
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    langs, centroids, radius = [], [], []
    for lang in dict.fromkeys(found["lang"]):
        own_rows = x[(found["lang"] == lang).to_numpy()]
        c, own = clustered(own_rows, s)
        cosine = (own_rows * c[own]).sum(1)
        for k in range(len(c)):
            if (own == k).any():
                langs.append(lang)
                centroids.append(c[k])
                # twice as far as any document that was learned
                radius.append(1 - 2 * (1 - cosine[own == k].min()))
    return Model(langs, np.array(centroids, np.float32), np.array(radius), idf)


def language_scores(docs: DataFrame, learned: DataFrame, settings: Settings = Settings(), reject: bool = False) -> DataFrame:
    """``docs`` (text, ...) with ``lang_pred``, ``lang_score`` (cosine to the nearest
    centroid, 0 to 1) and ``rejected`` (further from it than it allows).

    NULL text, and text without a letter, is ``und`` with score 0; with ``reject`` so is
    what is rejected. Judged by the whole text alone. Repeated rows agree; an empty
    table gives none; nothing learned makes all ``und``. Columns of these names are
    replaced. The model is some rows of ``buckets`` numbers per language; texts are not
    shuffled.
    """
    model = fit(learned, settings)

    @F.pandas_udf("lang_pred string, lang_score double, rejected boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [model.predict(t) for t in texts]
        frame = pd.DataFrame(rows, columns=["lang_pred", "lang_score", "rejected"])
        if reject:
            frame.loc[frame["rejected"], "lang_pred"] = UNKNOWN
        return frame

    out = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "rejected")]
    return docs.select(*out, of("text").alias("_p")).select(*out, "_p.*")
