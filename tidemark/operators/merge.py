"""Type 1 and Type 2 merges as DataFrame to DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import CURRENT, HASH, OPEN_FLAG, close_rows, col
from tidemark.operators.changes import (
    CHANGED,
    ROW_TYPE,
    TAGS,
    current_snapshot,
    has_full_key,
    has_null_key,
    rows_with,
    rows_without,
)
from tidemark.operators.sizing import few_keys, fits_by_rows
from tidemark.operators.skew import salted_left_join

CLOSE_SCOPES = ("current", "all")


class MergeParts(NamedTuple):
    """A merge result in two parts, so that the sink shuffles only one of them.

    ``in_place`` holds stored rows in the order of their files; ``moved`` holds
    rows that a key shuffle or the batch has brought in any order.
    """

    in_place: DataFrame | None
    moved: DataFrame

    def union(self) -> DataFrame:
        return self.moved if self.in_place is None else self.in_place.unionByName(self.moved)


def changed_keys(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    return classified.where(col(ROW_TYPE) == CHANGED).select(*[col(k) for k in keys])


def incoming_rows(classified: DataFrame) -> DataFrame:
    """The batch's rows as they are stored: without the tags."""
    return classified.drop(*TAGS)


def retained_rows(
    table: DataFrame,
    classified: DataFrame,
    keys: Sequence[str],
    unique_keys: bool = False,
    changed: int | None = None,
) -> DataFrame:
    """Stored rows whose key did not change. ``unique_keys`` says that the table has a
    key once or so, which saves looking for hot ones; ``changed``, how many rows of
    ``classified`` are changed ones, if that is known, which saves counting them."""
    columns = [col(c) for c in table.columns]
    gone = changed_keys(classified, keys)
    few = few_keys(gone, keys, changed)
    if few is not None:
        return table.join(few, list(keys), "left_anti").select(*columns)
    if not unique_keys:
        return rows_without(table, gone.distinct(), keys)
    # rows without a key match nothing: they pass by the shuffle, where they
    # would all meet in one task
    keyed = table.where(has_full_key(keys)).join(gone, list(keys), "left_anti").select(*columns)
    return keyed.unionByName(table.where(has_null_key(keys)))


def superseded_rows(
    table: DataFrame, classified: DataFrame, keys: Sequence[str], run_date: date | str
) -> DataFrame:
    """Open versions of changed keys, closed. Earlier history is not touched."""
    hit = changed_keys(classified, keys)
    few = few_keys(hit, keys)
    if few is not None:
        closed = current_snapshot(table).join(few, list(keys), "left_semi")
    else:
        closed = rows_with(current_snapshot(table), hit.distinct(), keys)
    return close_rows(closed, run_date).select(*[col(c) for c in table.columns])


def scd1_parts(
    table: DataFrame,
    classified: DataFrame,
    keys: Sequence[str],
    unique_keys: bool = True,
    changed: int | None = None,
) -> MergeParts:
    """Type 1: changed keys lose their stored rows, the batch's rows take their place.
    ``unique_keys=False`` says that the table may hold a key in any number; ``changed``
    as for `retained_rows`."""
    incoming = incoming_rows(classified)
    few = few_keys(changed_keys(classified, keys), keys, changed)
    if few is not None:
        kept = table.join(few, list(keys), "left_anti").select(*[col(c) for c in table.columns])
        return MergeParts(kept, incoming)
    keyed = retained_rows(table.where(has_full_key(keys)), classified, keys, unique_keys, changed)
    return MergeParts(table.where(has_null_key(keys)), keyed.unionByName(incoming))


def scd1_merge(
    table: DataFrame,
    classified: DataFrame,
    keys: Sequence[str],
    unique_keys: bool = True,
    changed: int | None = None,
) -> DataFrame:
    """Retained, new and changed rows."""
    return scd1_parts(table, classified, keys, unique_keys, changed).union()


def scd2_parts(
    table: DataFrame,
    classified: DataFrame,
    keys: Sequence[str],
    run_date: date | str,
    close_scope: str = "current",
    unique_keys: bool = True,
    changed: int | None = None,
) -> MergeParts:
    """Type 2: open versions of changed keys are closed, the batch's rows are added.

    Few changed keys are broadcast: the stored rows are read once and not
    shuffled. Otherwise only open versions are shuffled, by key; history passes
    by, whatever share of it one key holds. ``unique_keys=False`` says that a key
    may have open versions in any number; the result is the same either way.

    ``close_scope="all"`` is for tables kept by the older rule: every stored
    version of a changed key is closed anew, and versions that equal the new row
    are lost.
    """
    if close_scope not in CLOSE_SCOPES:
        raise ValueError(f"close_scope must be one of {CLOSE_SCOPES}")
    incoming = incoming_rows(classified)
    marks = (
        classified.where(col(ROW_TYPE) == CHANGED)
        .groupBy(*[col(k) for k in keys])
        .agg(F.min(HASH).alias("_low"), F.max(HASH).alias("_high"))
        if close_scope == "all"
        else changed_keys(classified, keys).distinct()
    ).withColumn("_hit", F.lit(True))
    hit = F.col("_hit").isNotNull()

    def closed(marked: DataFrame) -> DataFrame:
        if close_scope == "all":
            differs = (F.col("_low") != col(HASH)) | (F.col("_high") != col(HASH))
            rows = close_rows(marked.where(~hit | differs), run_date, hit)
        else:
            rows = close_rows(marked, run_date, hit & (col(CURRENT) == OPEN_FLAG))
        return rows.select(*[col(c) for c in table.columns])

    if fits_by_rows(marks, changed) or changed is not None and fits_by_rows(marks):
        return MergeParts(closed(table.join(F.broadcast(marks), list(keys), "left")), incoming)

    keyed, passing = has_full_key(keys), has_null_key(keys)
    if close_scope == "current":
        keyed = (col(CURRENT) == OPEN_FLAG) & keyed
        passing = (col(CURRENT) != OPEN_FLAG) | col(CURRENT).isNull() | passing
    if unique_keys and close_scope == "current":
        marked = table.where(keyed).join(marks, list(keys), "left")
    else:
        marked = salted_left_join(table.where(keyed), marks, keys)
    return MergeParts(table.where(passing), closed(marked).unionByName(incoming))


def scd2_merge(
    table: DataFrame,
    classified: DataFrame,
    keys: Sequence[str],
    run_date: date | str,
    close_scope: str = "current",
    unique_keys: bool = True,
    changed: int | None = None,
) -> DataFrame:
    """Retained, closed, new and changed rows."""
    return scd2_parts(table, classified, keys, run_date, close_scope, unique_keys, changed).union()
