"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components, star_edges
from tidemark.llm.shared import ship, stage

SMALL = 64  # vectors of a piece up to which its pairs are checked one by one
PAIRS = 100_000  # pairs that are checked at a time
CHUNK = 2048  # vectors of a bucket that are compared with each other in one piece
ALTERNATIVES = 3  # signed axes of a rotation that probing considers
BUCKET = 512  # vectors that a bucket should own at most on average
MEET = 0.7  # chance that one rotation with its probes brings a pair at cosine 0.9 together
MISS = 1e-4  # chance that such a pair meets in no table, at that


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the columns (a power of two high), n log n."""
    n, columns = x.shape
    h = 1
    while h < n:
        x = x.reshape(n // (2 * h), 2, h, columns)
        x = np.stack([x[:, 0] + x[:, 1], x[:, 0] - x[:, 1]], axis=1)
        h *= 2
    return x.reshape(n, columns) / np.sqrt(n)


@dataclass(frozen=True)
class CrossPolytope:
    """``tables`` hashes, each of ``rotations`` pseudo-random rotations: the nearest
    signed axis of each. ``probes`` buckets of a table are looked up: its own, and
    those that the next nearest axes name, in order of the distance they give up."""

    tables: int
    rotations: int
    probes: int
    seed: int = 1

    @classmethod
    def for_count(cls, n: int, dims: int, probes: int = 3) -> CrossPolytope:
        """Rotations grow with the logarithm of the count, so buckets keep their size;
        tables grow with them, so the chance to miss a pair stays."""
        axes = 2 * _padded(dims)
        rotations = max(1, ceil(log(max(n, 1) / BUCKET) / log(axes)))
        tables = ceil(log(MISS) / log(1 - MEET**rotations))
        return cls(tables, rotations, probes)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, probes) bucket numbers of unit rows, the own bucket first. The
        number of axes is part of the number, so other dimensions never meet."""
        n = _padded(x.shape[1])
        columns = np.ascontiguousarray(np.pad(x, ((0, 0), (0, n - x.shape[1]))).T)
        signs = np.random.default_rng(self.seed).choice((-1.0, 1.0), (self.tables, self.rotations, 3, n))
        top = min(ALTERNATIVES, 2 * n)
        combos = np.array(sorted(product(range(top), repeat=self.rotations), key=sum))
        out = np.empty((len(x), self.tables, min(self.probes, len(combos))), np.int64)
        for t in range(self.tables):
            loss, axis = [], []
            for r in range(self.rotations):
                y = columns
                for flip in signs[t, r]:
                    y = hadamard(y * flip[:, None])
                y = np.concatenate([y, -y]).T
                best = np.argpartition(-y, top - 1, axis=1)[:, :top]
                score = np.take_along_axis(y, best, 1)
                order = np.argsort(-score, axis=1, kind="stable")
                axis.append(np.take_along_axis(best, order, 1))
                score = np.take_along_axis(score, order, 1)
                loss.append((score[:, :1] - score) ** 2)
            cost = sum(part[:, combos[:, r]] for r, part in enumerate(loss))
            chosen = np.argsort(cost, axis=1, kind="stable")[:, : out.shape[2]]
            code = np.zeros(chosen.shape, np.int64)
            for r, part in enumerate(axis):
                code = code * (2 * n) + np.take_along_axis(part, combos[chosen, r], 1)
            out[:, t] = code
        return out


def _padded(dims: int) -> int:
    return 1 << max(0, (dims - 1).bit_length())


def unit(vectors: list) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that squares neither
    overflow nor vanish."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Not NULL, of finite components, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def embedding_groups(
    vectors: DataFrame, id_column: str, vector_column: str, threshold: float = 0.9, lsh: CrossPolytope | None = None
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``: how many other vectors
    it links with (cosine >= threshold), the smallest id that links reach, and whether
    that is its own.

    Equal vectors are one class, weighted by its rows. Classes are hashed into buckets;
    each is in its own bucket of every table and is looked up in its probes. Pairs that
    meet are verified by their cosine in double precision, in the task that holds the
    bucket; a pair is counted where it meets first, which both ends can tell from their
    own bucket numbers. What leaves a task are sums of links and a spanning star, never
    pairs. A bucket of more than CHUNK is cut into chunks and each two chunks make a
    piece of work, so a group of any size is spread and is compared in full.

    Rows that are not ``usable`` link with nothing. Vectors of different lengths never
    link. A NULL id counts as a vector, but is never the smallest; repeated ids are
    vectors of their own. Other columns are not read; an empty table gives none.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"))
    good = rows.where(usable(F.col("v")))
    classes = good.groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()))
    count, dims = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    lsh = lsh or CrossPolytope.for_count(count, dims or 1)

    pieces = _pieces(_hashed(classes, lsh))
    found = stage(_verified(pieces, lsh, threshold))
    links = found.where("links > 0").groupBy("cls").agg(F.sum("links").alias("links"))
    edges = found.where("root != cls").select(F.col("cls").alias("a"), F.col("root").alias("b"))
    components = connected_components(edges)

    named = classes.join(links, "cls", "left").join(components, classes["cls"] == components["node"], "left")
    named = named.select(
        "v",
        "low",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "cls").alias("root"),
    )
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stage(named.join(lowest, "root").select("v", "n_links", "component_id"))
    linked = good.join(named, "v").select("id", "n_links", "component_id")
    alone = rows.where(~usable(F.col("v"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


HASHED = "t int, bucket long, size int, own boolean, cls long, n long, v array<double>"


def _hashed(classes: DataFrame, lsh: CrossPolytope) -> DataFrame:
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["v"].map(len)
            for size, part in batch.groupby(sizes.to_numpy()):
                for low in range(0, len(part), 1000):
                    some = part.iloc[low : low + 1000]
                    codes = lsh.buckets(unit(some["v"].tolist()))
                    rows, tables, probes = codes.shape
                    at = np.repeat(np.arange(rows), tables * probes)
                    yield pd.DataFrame(
                        {
                            "t": np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), rows),
                            "bucket": codes.ravel(),
                            "size": np.int32(size),
                            "own": np.tile(np.arange(probes) == 0, rows * tables),
                            "cls": some["cls"].to_numpy()[at],
                            "n": some["n"].to_numpy()[at],
                            "v": some["v"].to_numpy()[at],
                        }
                    )

    schema = HASHED.replace("array<double>", classes.schema["v"].dataType.simpleString())
    return classes.select("cls", "n", "v").mapInPandas(hashed, schema)


UNIT = ["t", "bucket", "size", "i", "j"]


def _pieces(hashed: DataFrame) -> DataFrame:
    """Rows per piece of work: pairs of chunks of a bucket, one piece if it is small.
    Buckets where nothing can meet, of one row or with no vector of their own, go."""
    key = ["t", "bucket", "size"]
    per_bucket = hashed.groupBy(*key).agg(F.count("*").alias("rows"), F.sum(F.col("own").cast("int")).alias("owners"))
    per_bucket = per_bucket.where("rows > 1 and owners > 0")
    per_bucket = stage(per_bucket.select(*key, F.ceil(F.col("rows") / F.lit(CHUNK)).cast("int").alias("chunks")))
    rows = hashed.join(per_bucket, key)
    rows = rows.withColumn("c", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    units = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda x: F.struct(F.least("c", x).alias("i"), F.greatest("c", x).alias("j")),
    )
    rows = rows.withColumn("u", F.explode(units)).select(*key, "u.i", "u.j", "c", "own", "cls", "n", "v")
    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT)


def _verified(pieces: DataFrame, lsh: CrossPolytope, threshold: float) -> DataFrame:
    """(cls, links, root): links counted in some pieces, and the smallest class that
    their links reach."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            begins = _begins(rest)
            if len(begins) > 1:  # the last piece may go on in the next batch
                yield from _checked(rest.iloc[: begins[-1]], lsh, threshold)
                rest = rest.iloc[begins[-1] :].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from _checked(rest, lsh, threshold)

    return pieces.mapInPandas(verify, "cls long, links long, root long")


def _begins(rows: pd.DataFrame) -> np.ndarray:
    keys = rows[UNIT].to_numpy()
    return np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])


def _checked(rows: pd.DataFrame, lsh: CrossPolytope, threshold: float) -> Iterator[pd.DataFrame]:
    for _, same in rows.groupby("size", sort=False):
        x, own, cls = unit(same["v"].tolist()), same["own"].to_numpy(), same["cls"].to_numpy()
        a, b = _pairs(same, x, own, threshold)
        if not len(a):
            continue
        # positions stand for classes from here: a class is in several pieces
        used, place = np.unique(cls, return_inverse=True)
        linked, inverse = np.unique(place[np.r_[a, b]], return_inverse=True)
        first_row = np.zeros(len(used), np.int64)
        first_row[place] = np.arange(len(cls))
        codes = lsh.buckets(x[first_row[linked]])
        table, bucket = same["t"].to_numpy()[a], same["bucket"].to_numpy()[a]
        once = _meets_first(codes, inverse[: len(a)], inverse[len(a) :], table, bucket)
        n, links = same["n"].to_numpy(), np.zeros(len(used), np.int64)
        np.add.at(links, place[a[once]], n[b[once]])
        np.add.at(links, place[b[once]], n[a[once]])
        root = used[star_edges(place[a], place[b], len(used))]
        some = (links > 0) | (root != used)
        yield pd.DataFrame({"cls": used[some], "links": links[some], "root": root[some]})


def _pairs(rows: pd.DataFrame, x: np.ndarray, own: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the verified pairs of each piece, one of which is in its own bucket."""
    begins = _begins(rows)
    sizes = np.diff(np.r_[begins, len(rows)])
    low, high, chunk = (rows[c].to_numpy() for c in "ijc")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # small pieces together, pair by pair
    few = np.repeat((sizes <= SMALL) & (low[begins] == high[begins]), sizes)
    after = np.where(few, np.repeat(begins + sizes, sizes) - np.arange(len(rows)) - 1, 0)
    ends = np.cumsum(after)
    start = 0
    while start < len(rows):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
        n = after[start:stop]
        a = np.repeat(np.arange(start, stop), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        met = own[a] | own[b]
        a, b = a[met], b[met]
        near = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
        found.append((a[near], b[near]))
        start = stop
    # large ones as products of matrices
    for begin, size in zip(begins, sizes):
        if few[begin]:
            continue
        at = np.arange(begin, begin + size)
        if low[begin] == high[begin]:
            mine = at[own[at]]
            a, b = np.nonzero(x[mine] @ x[at].T >= threshold)
            a, b = mine[a], at[b]
            once = (a < b) | (a > b) & ~own[b]
            a, b = a[once], b[once]
        else:
            left, right = at[chunk[at] == low[begin]], at[chunk[at] == high[begin]]
            a, b = np.nonzero(x[left] @ x[right].T >= threshold)
            a, b = left[a], right[b]
        met = own[a] | own[b]
        found.append((a[met], b[met]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _meets_first(codes: np.ndarray, a: np.ndarray, b: np.ndarray, table: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Which pairs meet in no table before theirs and in no smaller bucket of it."""
    keep = np.ones(len(a), bool)
    for low in range(0, len(a), PAIRS):
        cut = slice(low, low + PAIRS)
        i, j, own_table, own_bucket = a[cut], b[cut], table[cut], bucket[cut]
        first = keep[cut]
        for t in range(int(own_table.max()) + 1):
            in_j = (codes[j, t] == codes[i, t, :1]).any(axis=1)  # i's own bucket is probed by j
            in_i = (codes[i, t] == codes[j, t, :1]).any(axis=1)
            smaller = (in_j & (codes[i, t, 0] < own_bucket)) | (in_i & (codes[j, t, 0] < own_bucket))
            first &= ~(((t < own_table) & (in_i | in_j)) | ((t == own_table) & smaller))
    return keep
