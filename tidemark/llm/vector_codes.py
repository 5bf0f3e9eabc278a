"""Product codes of vectors: integer k-means per part, with adaptive distance bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import col
from tidemark.llm.shared import scratch, ship
from tidemark.operators import fits_by_rows, salted_left_join
from tidemark.sources.filesystem import Directory

SCALE = 1024
MOST_BOUNDS, LEAST_BOUNDS = 32, 4  # entries whose bounds are kept, at most and at least
MANY_SCANS = 0.1  # share of parts compared with all entries from which more bounds are kept
DEEP = 0.9  # share of the uncertain parts whose depth decides how many bounds are kept
ROWS = 4096  # vectors that are worked on at a time
NONE = np.uint16(0xFFFF)  # stands for no entry


class Nearest(NamedTuple):
    """Per vector, for one part: the entry it belongs to and an upper bound of the distance
    to it; the closest other entries with lower bounds of theirs, in order; a lower
    bound for all others; how many bounds the last round had to look behind."""

    own: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray
    depth: np.ndarray


def _down(x: np.ndarray) -> np.ndarray:
    """A 32-bit number that is no more than ``x`` and whose last byte is zero, so that it
    takes three bytes where it is stored."""
    near = np.maximum(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(0))
    return (near.view(np.uint32) & np.uint32(0xFFFFFF00)).view(np.float32)


def _up(x: np.ndarray) -> np.ndarray:
    near = np.nextafter(x.astype(np.float32), np.float32(np.inf))
    return ((near.view(np.uint32) + np.uint32(0xFF)) & np.uint32(0xFFFFFF00)).view(np.float32)


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to each of ``book``, as integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    # whole numbers below 2^53 are exact as doubles, in any order of addition
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    found = (x * x).sum(1)[:, None] + (book * book).sum(1) - 2 * (x @ book.T)
    return found.astype(np.int64)


def _to_some(x: np.ndarray, book: np.ndarray, entries: np.ndarray) -> np.ndarray:
    apart = x[:, None, :] - book[entries]
    return (apart * apart).sum(2)


def scanned(x: np.ndarray, book: np.ndarray, kept: int) -> Nearest:
    """Compared with all entries."""
    found = squared(x, book)
    own = found.argmin(1)  # the first of equals
    rows = np.arange(len(x))
    upper = _up(np.sqrt(found[rows, own]))
    found[rows, own] = np.iinfo(np.int64).max
    kept = min(kept, len(book) - 1)
    some = min(kept + 1, len(book) - 1)
    if not some:
        none = np.zeros((len(x), 0))
        return Nearest(own, upper, none.astype(np.int64), none.astype(np.float32), np.full(len(x), np.inf, np.float32), np.full(len(x), 0))
    near = np.argpartition(found, some - 1, axis=1)[:, :some] if some < len(book) else np.argsort(found, axis=1)[:, :some]
    near = np.take_along_axis(near, np.take_along_axis(found, near, 1).argsort(1, kind="stable"), 1)
    lower = _down(np.sqrt(np.take_along_axis(found, near, 1)))
    outer = lower[:, kept] if some > kept else np.full(len(x), np.inf, np.float32)
    return Nearest(own, upper, near[:, :kept], lower[:, :kept], outer, np.full(len(x), kept + 1))


def moved(last: Nearest, x: np.ndarray, book: np.ndarray, moves: np.ndarray, kept: int) -> Nearest:
    """The nearest entries after the entries have moved by ``moves``.

    Bounds that still keep all others away settle most vectors. For the others the
    distance to the own entry is worked out, then those to the near entries whose
    bounds are not above it, and those to all where the outer bound is not. These are
    integers, so ties go to the lower index whatever the bounds have lost.
    """
    n, (own, upper, near, lower, outer, _) = len(x), last
    upper = _up(upper.astype(np.float64) + moves[own])
    there = near != NONE
    lower = np.where(there, _down(lower.astype(np.float64) - moves[np.where(there, near, 0)]), np.float32(np.inf))
    outer = np.where(np.isinf(outer), outer, _down(outer.astype(np.float64) - moves.max(initial=0)))
    order = lower.argsort(1, kind="stable")
    near, lower = np.take_along_axis(near, order, 1), np.take_along_axis(lower, order, 1)
    nearest = np.minimum(outer, lower.min(1, initial=np.inf))
    own, depth = own.copy(), np.zeros(n, np.int64)

    open_rows = np.flatnonzero(upper >= nearest)
    exact = _to_some(x[open_rows], book, own[open_rows, None])[:, 0]
    upper[open_rows] = _up(np.sqrt(exact))
    still = upper[open_rows] >= nearest[open_rows]
    open_rows, exact = open_rows[still], exact[still]

    local = upper[open_rows] < outer[open_rows]
    rows = open_rows[local]
    if len(rows):
        # the last round may have kept more bounds than this one does
        depth[rows] = np.minimum((lower[rows] <= upper[rows, None]).sum(1), kept)
        entries = np.concatenate([own[rows, None], near[rows].astype(np.int64)], 1)
        absent = entries == NONE
        found = _to_some(x[rows], book, np.where(absent, 0, entries))
        found[absent] = np.iinfo(np.int64).max
        order = np.lexsort((entries, found), axis=1)
        entries, found, absent = (np.take_along_axis(a, order, 1) for a in (entries, found, absent))
        own[rows], near[rows] = entries[:, 0], entries[:, 1:]
        upper[rows] = _up(np.sqrt(found[:, 0]))
        lower[rows] = np.where(absent[:, 1:], np.float32(np.inf), _down(np.sqrt(found[:, 1:])))
    near, lower, outer = _resized(near, lower, outer, kept)
    rows = open_rows[~local]
    if len(rows):
        new = scanned(x[rows], book, kept)
        own[rows], upper[rows], outer[rows], depth[rows] = new.own, new.upper, new.outer, kept + 1
        width = new.near.shape[1]
        near[rows, :width], lower[rows, :width] = new.near, new.lower
        near[rows, width:], lower[rows, width:] = NONE, np.inf
    return Nearest(own, upper, near, lower, outer, depth)


def _resized(near, lower, outer, kept):
    """``kept`` bounds each: those beyond become part of the outer one."""
    width = near.shape[1]
    if width >= kept:
        return near[:, :kept].copy(), lower[:, :kept].copy(), np.minimum(outer, lower[:, kept:].min(1, initial=np.inf))
    more = ((0, 0), (0, kept - width))
    return np.pad(near, more, constant_values=NONE), np.pad(lower, more, constant_values=np.inf), outer


class Codebooks(NamedTuple):
    """``entries[part, entry]`` are the integer components of a codebook's entry."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _packed(parts: list[Nearest]) -> list[bytes]:
    """One record per vector of what is kept of all parts: the low bytes of all entries,
    then the high ones, and the bounds' bytes in the same way, which compress to half."""
    ids, bounds = [], []
    for p in parts:
        ids += [p.own.astype("<u2")[:, None], p.near.astype("<u2"), p.depth.astype("<u2")[:, None]]
        bounds += [p.upper[:, None], p.lower, p.outer[:, None]]
    table = np.concatenate([_planes(np.concatenate(ids, 1)), _planes(np.concatenate(bounds, 1).astype("<f4"))], 1)
    return [r.tobytes() for r in table]


def _planes(rows: np.ndarray) -> np.ndarray:
    single = np.ascontiguousarray(rows).view(np.uint8).reshape(*rows.shape, rows.itemsize)
    return single.transpose(0, 2, 1).reshape(len(rows), -1)


def _unpacked(records: list[bytes], parts: int, kept: int) -> list[Nearest]:
    table = np.frombuffer(b"".join(records), np.uint8).reshape(len(records), -1)
    each = parts * (kept + 2)

    def whole(planes: np.ndarray, kind: str) -> np.ndarray:
        planes = planes.reshape(len(records), -1, each)
        numbers = planes[:, 0].astype(kind)
        for n in range(1, planes.shape[1]):
            numbers |= planes[:, n].astype(kind) << (8 * n)
        return numbers.reshape(len(records), parts, kept + 2)

    ids, bounds = whole(table[:, : 2 * each], "<u2"), whole(table[:, 2 * each :], "<u4").view("<f4")
    return [
        Nearest(i[:, 0].astype(np.int64), b[:, 0].copy(), i[:, 1:-1], b[:, 1:-1], b[:, -1].copy(), i[:, -1].astype(np.int64))
        for i, b in ((ids[:, p], bounds[:, p]) for p in range(parts))
    ]


def usable(vector: Column) -> Column:
    """Neither NULL nor with a NULL or non-finite component."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def compress_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, parts: int = 4, entries: int = 256, rounds: int = 4
) -> tuple[DataFrame, Codebooks]:
    """``vectors`` without the vector, with ``codes`` (an entry of each part's codebook) and
    ``error`` (squared distance, summed over parts), and the codebooks.

    Components are scaled to integers, floor(1024 x). The codebooks begin as the parts
    of the vectors with the smallest ids (NULL last, then by vector) and are moved
    ``rounds`` times to the floor of their vectors' mean. All distances that decide are
    integers; ties go to the lower index. Each round is one pass over a table of the
    integer vectors, their closest entries and the bounds; how many bounds are kept
    follows from how deep the last round had to look. The driver holds the codebooks
    and their sums alone, which do not grow with the vectors; a round's table goes when
    the next is there.

    Rows with a NULL vector, or NULL or non-finite components, are left out. Fewer
    vectors than entries make smaller codebooks; none, an empty result. Repeated rows
    count as often as they are there. Vectors of different lengths, of a length that
    ``parts`` does not divide, or with components so large that squared distances pass
    64 bits, are refused. Columns named ``codes`` or ``error`` are replaced.
    """
    spark = vectors.sparkSession
    ship(spark)
    others = [c for c in vectors.columns if c not in (vector_col, "codes", "error")]
    kept = vectors.where(usable(col(vector_col)))
    whole = F.transform(col(vector_col), lambda x: F.floor(x.cast("double") * SCALE))
    size, top = F.size(col(vector_col)), F.array_max(F.transform(col(vector_col), lambda x: F.abs(x.cast("double"))))
    found = kept.agg(F.count("*"), F.min(size), F.max(size), F.coalesce(F.max(top), F.lit(0.0))).first()
    count, low, dims, largest = found
    other_types = [f for f in vectors.schema if f.name in others]
    if not count:
        return kept.select(*[col(c) for c in others], F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")), Codebooks(
            np.zeros((parts, 0, 0), np.int64)
        )
    if low != dims or dims % parts:
        raise ValueError(f"vectors must have one length that {parts} divides, not {low} to {dims}")
    if 4 * dims * ((largest + 1) * SCALE) ** 2 >= 1 << 62:
        raise ValueError(f"components up to {largest} are too large for distances of 64 bits")
    if entries >= NONE:
        raise ValueError(f"a codebook has less than {NONE} entries")
    first = kept.orderBy(col(id_col).asc_nulls_last(), col(vector_col)).limit(entries).select(whole.alias("v")).collect()
    seeds = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dims // parts)
    books = np.ascontiguousarray(seeds.transpose(1, 0, 2))
    moves = np.zeros(books.shape[:2])
    kind = "<i2" if (largest + 1) * SCALE < 1 << 15 else "<i4"

    # the user's columns as one, so that no name meets another
    user = F.struct(*[col(c) for c in others]) if others else F.lit(None).cast("string")
    table = kept.select(user.alias("user"), whole.alias("v"))
    bounds, width, folder = min(MOST_BOUNDS, max(LEAST_BOUNDS, entries // 8)), 0, None
    for n in range(rounds + 1):
        task = _pass(table, parts, kind, books, moves, width if n else None, bounds)
        ahead = scratch(spark)
        task.write.parquet(ahead)
        table, width = spark.read.schema(task.schema).parquet(ahead), bounds
        if folder:
            Directory(spark, folder).delete()
        folder = ahead
        if n < rounds:
            sums, counts, depths = _sums(table, parts, len(first), dims // parts, kind, bounds)
            new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
            moves = np.nextafter(np.sqrt(((new - books) ** 2).sum(2).astype(np.float64)), np.inf)
            books, bounds = new, _adapted(depths, bounds)
    result = table.select(*[F.col("user").getField(f.name).alias(f.name) for f in other_types], "codes", "error")
    return result, Codebooks(books)


def _pass(table, parts, kind, books, moves, width, bounds) -> DataFrame:
    """One round over the vectors: integer vectors, entries, bounds and errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), ROWS):
                part = batch.slice(low, ROWS)
                x = _vectors(part["v"], kind).reshape(len(part), parts, -1)
                if width is None:
                    done = [scanned(x[:, p], books[p], bounds) for p in range(parts)]
                    done = [d._replace(**dict(zip(("near", "lower", "outer"), _resized(d.near, d.lower, d.outer, bounds), strict=True))) for d in done]
                else:
                    last = _unpacked(part["state"].to_pylist(), parts, width)
                    done = [moved(last[p], x[:, p], books[p], moves[p], bounds) for p in range(parts)]
                codes = np.stack([d.own for d in done], 1)
                error = sum(_to_some(x[:, p], books[p], codes[:, p, None])[:, 0] for p in range(parts))
                ints = np.ascontiguousarray(x.reshape(len(part), -1).astype(kind))
                columns = [
                    part["user"],
                    pa.array([r.tobytes() for r in ints], pa.binary()),
                    pa.array(_packed(done), pa.binary()),
                    pa.array(codes.astype(np.int32).tolist(), pa.list_(pa.int32())),
                    pa.array(error),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["user", "v", "state", "codes", "error"])

    user = table.schema["user"].dataType.simpleString()
    names = [c for c in ("user", "v", "state") if c in table.columns]
    ddl = f"user {user}, v binary, state binary, codes array<int>, error long"
    return table.select(*names).mapInArrow(run, ddl)


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _sums(table, parts, entries, dims, kind, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and counts of the vectors of each entry, and how often each depth was needed.
    A task adds up its own; as many rows as the codebooks have numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, dims + 1), np.int64)
        depths = np.zeros(bounds + 2, np.int64)
        for batch in batches:
            for low in range(0, len(batch), ROWS):
                part = batch.slice(low, ROWS)
                x = _vectors(part["v"], kind).reshape(len(part), parts, dims)
                for p, found in enumerate(_unpacked(part["state"].to_pylist(), parts, bounds)):
                    np.add.at(total[p, :, :dims], found.own, x[:, p])
                    total[p, :, dims] += np.bincount(found.own, minlength=entries)
                    depths += np.bincount(found.depth, minlength=len(depths))
        for p in range(parts):
            place = np.flatnonzero(total[p])
            arrays = [pa.array(np.full(len(place), p)), pa.array(place), pa.array(total[p].ravel()[place])]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "place", "n"])
        arrays = [pa.array(np.full(len(depths), -1)), pa.array(np.arange(len(depths))), pa.array(depths)]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "place", "n"])

    rows = table.select("v", "state").mapInArrow(run, "part long, place long, n long")
    total, depths = np.zeros((parts, entries * (dims + 1)), np.int64), np.zeros(bounds + 2, np.int64)
    for part, place, n in rows.groupBy("part", "place").agg(F.sum("n")).collect():
        (depths if part < 0 else total[part])[place] = n
    total = total.reshape(parts, entries, dims + 1)
    return total[:, :, :dims], total[:, :, dims], depths


def _adapted(depths: np.ndarray, bounds: int) -> int:
    """How many bounds the next round keeps. ``depths``: parts settled by their bounds,
    by as many near entries, and last by all entries."""
    if depths[-1] > MANY_SCANS * depths.sum():
        return min(MOST_BOUNDS, 2 * bounds)
    looked = np.cumsum(depths[1:-1])
    if not looked.size or not looked[-1]:
        return max(LEAST_BOUNDS, bounds // 2)
    return int(np.clip(np.searchsorted(looked, DEEP * looked[-1]) + 1, LEAST_BOUNDS, bounds))


def summed_over(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows of equal ``group``, NULLs
    together. A group of any size is added up before it moves, and spread in the join."""
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = rows.withColumn("_group", named)
    sums = rows.groupBy("_group").agg(F.sum(value).alias(name))
    path = scratch(rows.sparkSession)
    sums.write.parquet(path)
    sums = rows.sparkSession.read.schema(sums.schema).parquet(path)
    if fits_by_rows(sums):
        joined = rows.join(F.broadcast(sums), "_group", "left")
    else:
        joined = salted_left_join(rows, sums, ["_group"])
    return joined.drop("_group")
