"""Document fingerprints from closed syncmers, matched by position."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ship, shuffle_partitions

K = 16  # code points of an anchor
S = 6  # code points of its inner substrings
SKETCH = 64  # anchors that a fingerprint keeps
BLOCK = 1 << 16  # code points that are hashed at a time
RANGES = 4  # ranges of ids per shuffle partition

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def anchors(points: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of a text's code points: the k-mers
    of which the smallest s-mer, by hash, is the first or the last.

    Whether a k-mer is chosen depends on nothing around it, so equal passages have
    equal anchors wherever they stand. A text shorter than k is one anchor, an empty
    one has none, nor may one little longer than k (see ``named``). Long texts are done in overlapping blocks.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < k:
        digest = hashlib.blake2b(points.astype("<u4").tobytes(), digest_size=8).digest()
        return np.zeros(1, np.int64), np.frombuffer(digest, "<u8")
    where, what = [], []
    for low in range(0, n - k + 1, BLOCK):
        part = points[low : low + BLOCK + k - 1].astype(np.uint64)
        inner = len(part) - s + 1
        h = part[:inner].copy()
        for i in range(1, s):
            h *= _M1
            h += part[i : i + inner]
        h = _mixed(h)
        window = k - s + 1
        least, span = h, 1
        while span < window:
            step = min(span, window - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        m = len(least)
        at = np.flatnonzero((h[:m] == least) | (h[window - 1 : window - 1 + m] == least))
        # s-mers that cover the k-mer together name it
        own = h[at]
        for i in [*range(s, k - s, s), k - s]:
            own = own * _M1 + h[at + i]
        where.append(at + low)
        what.append(_mixed(own))
    return np.concatenate(where), np.concatenate(what)


def named(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``anchors``; a text of at least K code points that has no closed syncmer is one
    anchor, as a shorter one is, so only an empty text has none."""
    where, what = anchors(points)
    if len(where) or not len(points):
        return where, what
    digest = hashlib.blake2b(points.astype("<u4").tobytes(), digest_size=8).digest()
    return np.zeros(1, np.int64), np.frombuffer(digest, "<u8")


def sketch(text: str, size: int = SKETCH) -> str:
    """The ``size`` smallest anchor hashes of the whole text, each with the position
    where it first occurs, as base64: 32-bit hashes in ascending order, then positions."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    where, what = named(points)
    what = (what >> np.uint64(32)).astype(np.uint32)
    if len(what) > 4 * size:
        # as many small hashes as certainly hold `size` distinct ones, or all
        for many in (4 * size, len(what)):
            few = np.argpartition(what, many - 1)[:many] if many < len(what) else np.arange(len(what))
            few = np.sort(few)
            if many == len(what) or len(np.unique(what[few])) > size:
                where, what = where[few], what[few]
                break
    hashes, first = np.unique(what, return_index=True)
    hashes, places = hashes[:size], where[first[:size]]
    return base64.b64encode(hashes.astype("<u4").tobytes() + places.astype("<u4").tobytes()).decode()


def likeness(a: str, b: str, size: int = SKETCH) -> float:
    """Of the ``size`` smallest anchors of both texts together, the share that both
    have in the same order: a Jaccard likeness by position, from 0 to 1. Two empty
    texts are alike."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(base64.b64decode(s), "<u4") for s in (a, b))
    x, at_x, y, at_y = x[: len(x) // 2], x[len(x) // 2 :], y[: len(y) // 2], y[len(y) // 2 :]
    if not len(x) or not len(y):
        return 0.0
    union = np.union1d(x, y)[:size]
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    inside = both <= union[-1]
    i, j = i[inside], j[inside]
    order = np.argsort(at_x[i], kind="stable")
    # the longest run of anchors that rise in both texts
    tails: list[int] = []
    for p in at_y[j][order].tolist():
        n = bisect_left(tails, p)
        tails[n : n + 1] = [p]
    return len(tails) / len(union)


def edited(text: str, following: str) -> str:
    """``text``, its last floor(n / 2) code points replaced by the first of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole ``docs`` texts and of an edit of each, and their likeness.

    The edit takes its second half from the next document by descending doc_id; after
    the last comes the first. NULL text is empty. Rows of a doc_id are ordered by
    their texts' hash; NULL doc_ids come last; one row alone follows itself. Other
    columns are not read; an empty table gives none.

    Ids are cut into ranges at quantiles, so a range is a small share of the rows
    whatever the ids are. Each text moves once, to its range; the first row of each
    range moves a second time, to end the range before it. A task reads its ranges in
    order and holds two rows and a batch.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ranges = RANGES * shuffle_partitions(spark)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, ids.to_numpy(), "left").astype(np.int32))

    # ranges count downwards in the ids; NULL is in the last
    number = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    descending = [F.col("doc_id").desc_nulls_last(), F.col("_tie")]
    # per range its first row, as a sort key: one row per range
    key = F.struct(number.alias("id"), (-1 - F.col("_tie")).alias("tie"))
    heads = rows.select(range_of(number).alias("range"), key.alias("key"))
    heads = heads.groupBy("range").agg(F.max("key").alias("head")).orderBy("range").collect()
    before = {r["range"]: heads[n - 1]["range"] for n, r in enumerate(heads)}

    ids = [(before[r["range"]], *r["head"]) for r in heads]
    borders = spark.createDataFrame(ids, "range int, _id long, _t long")
    ends = rows.join(
        F.broadcast(borders),  # as many rows as ranges
        (number == F.col("_id")) & ((-1 - F.col("_tie")) == F.col("_t")),
    )
    ends = ends.dropDuplicates(["range"]).select("range", "doc_id", "text", "_tie", F.lit(True).alias("_end"))
    body = rows.select(range_of(number).alias("range"), "doc_id", "text", "_tie", F.lit(False).alias("_end"))
    placed = body.unionByName(ends).repartition(shuffle_partitions(spark), "range")
    placed = placed.sortWithinPartitions("range", "_end", *descending)
    # as text, since pandas would make floats of ids with NULLs among them
    return placed.select(F.col("doc_id").cast("string"), "text", "_end").mapInPandas(_followed, RESULT)


def _followed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs each row with the next; the end row of a range is only a next."""
    held, out = None, []
    for batch in batches:
        for doc_id, text, is_end in zip(batch["doc_id"], batch["text"], batch["_end"], strict=True):
            print_ = sketch(text)
            if held is not None:
                out.append(_row(*held, text, print_))
            held = None if is_end else (doc_id, text, print_)
            if len(out) >= 1000:
                yield _frame(out)
                out = []
    if out:
        yield _frame(out)


def _row(doc_id, text: str, print_: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    new = print_ if changed == text else sketch(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    doc_id = None if doc_id is None else int(doc_id)
    return doc_id, len(text), digest, print_, new, likeness(print_, new), likeness(print_, next_print)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(",")])
    return frame.astype({"doc_id": "Int64"})


def anchor_table(docs: DataFrame) -> DataFrame:
    """(doc_id, position, anchor) of every anchor of every text: rows that a join on
    ``anchor`` matches across documents. Empty texts give no row."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                where, what = named(np.frombuffer((text or "").encode("utf-32-le"), "<u4"))
                ids = pd.array([None if doc_id is None else int(doc_id)], dtype="Int64").repeat(len(where))
                yield pd.DataFrame({"doc_id": ids, "position": where, "anchor": what.view(np.int64)})

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInPandas(found, "doc_id long, position long, anchor long")
