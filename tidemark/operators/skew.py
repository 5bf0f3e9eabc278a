"""Joins that stay spread out when one key fills much of the left side."""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import col

HEAVY_ROWS = 1_000_000
# keys that a sketch follows. One with more than 3.5 / TRACKED of all rows is in it for
# certain; any other holds less than a two thousandth of them
TRACKED = 8192


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Equal for keys that a join takes for equal, 0.0 and -0.0 among them."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)}
    return F.xxhash64(*[col(k) + F.lit(0.0) if k in floating else col(k) for k in keys])


def key_sketch(df: DataFrame, keys: Sequence[str], tracked: int = TRACKED) -> Column:
    """The most frequent keys of ``df`` and their counts, as text: a mergeable sketch of
    fixed size, for `DataFrame.agg` or, at no job of its own, for `DataFrame.observe`."""
    top = F.call_function("approx_top_k", _key_hash(df, keys), F.lit(tracked), F.lit(tracked))
    return F.to_json(top)


def heavy_of(sketch: str | None, heavy_rows: int = HEAVY_ROWS) -> dict[int, int]:
    """Salts by key hash, for the keys of a sketch with more than ``heavy_rows`` rows."""
    found = json.loads(sketch or "[]")
    return {r["item"]: -(-r["count"] // heavy_rows) for r in found if r["count"] > heavy_rows and r.get("item") is not None}


def heavy_keys(df: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> dict[int, int]:
    """Salts by key hash, found in one pass over the keys without a shuffle of them."""
    return heavy_of(df.agg(key_sketch(df, keys).alias("sketch")).first()["sketch"], heavy_rows)


def _row_hashes(df: DataFrame) -> list[Column]:
    hashable = [col(f.name) for f in df.schema if not isinstance(f.dataType, T.MapType | T.VariantType)]
    return [F.xxhash64(*hashable), F.xxhash64(F.lit("second"), *hashable)]


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    heavy_rows: int = HEAVY_ROWS,
    how: str = "left",
    heavy: dict[int, int] | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)``; ``right`` has one row per key. ``how`` may
    also be ``left_semi`` or ``left_anti``.

    A sketch of the left keys names those with more than ``heavy_rows`` rows; ``heavy`` is
    one that was taken before. Without any this is the plain join. Else the rows of heavy
    keys are joined apart: each key has a salt for each so many rows, and only its right
    row is repeated. The salt is the row's number within its task, after its heavy rows
    are sorted: equal rows get different ones, and a task that is run again the same.
    The list of heavy keys has TRACKED entries at most and is broadcast.
    """
    keys = list(keys)
    if heavy is None:
        heavy = heavy_keys(left, keys, heavy_rows)
    if not heavy:
        return left.join(right, keys, how)
    key, salts, salt = (f"{name}-{uuid4().hex}" for name in ("hash", "salts", "salt"))
    listed = F.broadcast(left.sparkSession.createDataFrame(list(heavy.items()), f"`{key}` long, `{salts}` int"))
    hashed = left.withColumn(key, _key_hash(left, keys))
    light = hashed.join(listed, key, "left_anti").drop(key).join(right, keys, how)

    hot = hashed.join(listed, key)
    # by their values, so that the right side is matched as a join matches it
    named = F.broadcast(hot.groupBy(*[col(k) for k in keys]).agg(F.max(salts).alias(salts)))
    hot = hot.sortWithinPartitions(*_row_hashes(left)).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.col(salts)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col(salts) - 1))
    repeated = right.join(named, keys).withColumn(salt, every).drop(salts)
    found = hot.drop(key, salts).join(repeated, [*keys, salt], how).drop(salt)
    return light.unionByName(found)
