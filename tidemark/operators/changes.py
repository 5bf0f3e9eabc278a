"""Classification of a batch against the stored table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import CURRENT, HASH, OPEN_FLAG, PARTITION, col
from tidemark.operators.sizing import estimated_bytes, few_keys
from tidemark.operators.skew import salted_left_join

ROW_TYPE = "rowType"
P_KEY = "pKey"
FIRST_P_KEY = "firstPKey"
OPEN_VERSIONS = "openVersions"
TAGS = (ROW_TYPE, P_KEY, FIRST_P_KEY, OPEN_VERSIONS)
# hashes under which a batch's row may be stored unchanged, besides its own
KNOWN = "knownHashes"
NEW = "NewRows"
CHANGED = "CurrentRows"

# a table of up to this size by Catalyst's estimate is shuffled rather than cut by a batch
# whose rows would first have to be counted
SMALL_TABLE = 32 << 20

ON_DUPLICATE = ("error", "last", "keep")
NULL_KEYS = ("error", "keep")


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [col(k).isNull() for k in keys])


def has_full_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [col(k).isNotNull() for k in keys])


def _refuse(when: Column, message: str) -> Column:
    """A predicate that is true, or fails the job where ``when`` holds."""
    return F.when(when, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def _null_message(keys: Sequence[str]) -> str:
    return f"NULL in merge key {list(keys)}"


def require_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch``, failing the job at the first row with a NULL in its key.

    The check is part of the key's value, not a filter: a not-null filter that
    Catalyst infers from a join cannot get in before it.
    """
    types = {f.name: f.dataType for f in batch.schema}
    refusal = F.raise_error(F.lit(_null_message(keys)))
    return batch.withColumns({k: F.coalesce(col(k), refusal.cast(types[k])) for k in keys})


def current_snapshot(table: DataFrame) -> DataFrame:
    """The open versions only. The predicate reaches the file scan."""
    return table.where(col(CURRENT) == OPEN_FLAG)


def _orderable(field: T.StructField) -> Column:
    nested = isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType | T.VariantType)
    return col(field.name).cast("string") if nested else col(field.name)


def dedupe_batch(
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_keys: str = "error",
) -> DataFrame:
    """At most one row per key, checked or chosen.

    ``error`` fails the job on a second row, ``last`` keeps the row that is
    greatest by ``order_by`` (then by its other columns, so ties are settled alike
    on every run), ``keep`` leaves the batch as it is. Rows with a NULL key fail the
    job, or with ``null_keys="keep"`` all stay: they are no duplicates of each other.

    The rank filter lets Spark cut each key to one or two rows within the map
    task, so a key that fills the batch is never gathered. The shuffle is by the
    merge key, which the join of `classify_changes` then reuses. It comes cheaper
    before the audit columns are added than after.
    """
    if on_duplicate == "keep":
        return batch
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    if on_duplicate == "last" and not order_by:
        raise ValueError("on_duplicate='last' needs order_by columns")

    if on_duplicate == "last":
        rest = [f for f in batch.schema if f.name not in (*keys, *order_by)]
        ties = [_orderable(f) for f in rest]
        order = [c.desc_nulls_last() for c in (*[col(c) for c in order_by], *ties)]
    else:
        order = [col(k) for k in keys]
    rank = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*order))
    if null_keys == "keep":
        keyed = batch.where(has_full_key(keys)).withColumn("_rank", rank)
    else:
        keyed = require_keys(batch, keys).withColumn("_rank", rank)
    if on_duplicate == "last":
        keyed = keyed.where(F.col("_rank") == 1)
    else:
        second = F.col("_rank") == 2
        keyed = keyed.where(F.col("_rank") <= 2).where(
            _refuse(second, f"duplicate merge key {list(keys)} in the batch")
        )
    keyed = keyed.drop("_rank")
    if null_keys == "keep":
        return keyed.unionByName(batch.where(has_null_key(keys)))
    return keyed


def _prints(row_hash: Column) -> list[Column]:
    """Two 64-bit numbers for a hash: their minima and maxima are kept in place by a
    hash aggregate, where those of texts would need a sort."""
    return [F.xxhash64(row_hash), F.xxhash64(F.lit("second"), row_hash)]


def _stored_summary(table: DataFrame, keys: Sequence[str], partitioned: bool) -> DataFrame:
    """One row per current key: bounds of its hashes and of where it is stored.

    A table that breaks the one-open-version rule can hold any number of open
    rows of a key. They are reduced before the shuffle, so the join below never
    fans out. A missing hash stands as '', which no hash equals.
    """
    aggregates = []
    for n, number in enumerate(_prints(F.coalesce(col(HASH), F.lit("")))):
        aggregates += [F.min(number).alias(f"_low{n}"), F.max(number).alias(f"_high{n}")]
    if partitioned:
        aggregates += [
            F.min(PARTITION).alias("_first"),
            F.max(PARTITION).alias("_last"),
            F.count(F.lit(1)).alias("_open"),
        ]
    return table.groupBy(*[col(k) for k in keys]).agg(*aggregates)


def _same_hash(known: bool = False) -> Column:
    """All stored hashes of the key are the row's own, or with ``known`` are one of those
    that it may be stored under."""

    def only(row_hash: Column) -> Column:
        bounds = [
            (F.col(f"_low{n}") == number) & (F.col(f"_high{n}") == number)
            for n, number in enumerate(_prints(row_hash))
        ]
        return reduce(Column.__and__, bounds)

    own = only(col(HASH))
    return own | F.exists(KNOWN, only) if known else own


def _keyed_current(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], batch_rows: int | None = None
) -> DataFrame:
    """Open versions that can match, cut to the batch's keys when those are few. A small
    table is not worth a job that counts the batch."""
    current = current_snapshot(table).where(has_full_key(keys))
    if batch_rows is None and estimated_bytes(table) <= SMALL_TABLE:
        return current
    batch_keys = few_keys(batch, keys, batch_rows)
    return current if batch_keys is None else current.join(batch_keys, list(keys), "left_semi")


def classify_changes(
    batch: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    null_keys: str = "error",
    unique_keys: bool = True,
    batch_rows: int | None = None,
    heavy: dict[int, int] | None = None,
) -> DataFrame:
    """New and changed rows of ``batch``, tagged; unchanged rows are left out.

    Adds ``rowType`` and, for a partitioned table, ``pKey`` and ``firstPKey`` (the
    highest and the lowest partition that holds an open version of the key; for
    new rows the batch's own) and ``openVersions``, their number. That is more
    than one only where an interrupted run or duplicate loads left several.

    A row has changed unless every open version of its key carries its hash; a
    stored NULL hash counts as different. One join finds new and changed rows
    alike. ``unique_keys=False`` says that a key may repeat in the batch, at any
    frequency; the result is the same either way. ``batch_rows`` and ``heavy`` (as
    `salted_left_join` takes it) are what is known of the batch already, and save the
    jobs that would find them out. A batch may have the column ``knownHashes``: an array of
    further hashes under any one of which a row counts as unchanged. It is not returned.
    """
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be one of {NULL_KEYS}")
    partitioned = PARTITION in batch.columns
    if null_keys == "error":
        # a filter here: it leaves the key, and so its partitioning, as they are
        keyed = batch.where(_refuse(has_null_key(keys), _null_message(keys)))
    else:
        keyed = batch.where(has_full_key(keys))

    stored = _stored_summary(_keyed_current(table, keyed, keys, batch_rows), keys, partitioned)
    if unique_keys:
        joined = keyed.join(stored, list(keys), "left")
    else:
        joined = salted_left_join(keyed, stored, keys, heavy=heavy)

    known = F.col("_low0").isNotNull()
    same = known & F.coalesce(_same_hash(KNOWN in batch.columns), F.lit(False))
    kept = [col(c) for c in batch.columns if c != KNOWN]
    tags = [F.when(known, F.lit(CHANGED)).otherwise(F.lit(NEW)).alias(ROW_TYPE)]
    if partitioned:
        tags += _places(F.col("_last"), F.col("_first"), F.col("_open"))
    result = joined.where(~same).select(*kept, *tags)

    if null_keys == "keep":
        tags = [F.lit(NEW).alias(ROW_TYPE)]
        if partitioned:
            nothing = F.lit(None).cast("int")
            tags += _places(nothing, nothing, nothing)
        unkeyed = batch.where(has_null_key(keys))
        result = result.unionByName(unkeyed.select(*kept, *tags))
    return result


def _places(last: Column, first: Column, number: Column) -> list[Column]:
    """Where the open versions are; a key without any counts as in its own partition."""
    own = col(PARTITION)
    return [
        F.coalesce(last, own).alias(P_KEY),
        F.coalesce(first, own).alias(FIRST_P_KEY),
        F.coalesce(number, F.lit(0)).cast("bigint").alias(OPEN_VERSIONS),
    ]


def rows_without(rows: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key is not in ``gone`` (distinct keys). Neither rows without a key,
    which all stay, nor those of a hot key meet in one task."""
    columns = [col(c) for c in rows.columns]
    keyed = salted_left_join(rows.where(has_full_key(keys)), gone, keys, how="left_anti")
    return keyed.select(*columns).unionByName(rows.where(has_null_key(keys)))


def rows_with(rows: DataFrame, hit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key is in ``hit`` (distinct keys), hot keys spread over tasks."""
    found = salted_left_join(rows.where(has_full_key(keys)), hit, keys, how="left_semi")
    return found.select(*[col(c) for c in rows.columns])


def new_rows(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key has no open version. Rows with a NULL key are new."""
    known = _keyed_current(table, batch, keys).select(*[col(k) for k in keys]).distinct()
    return rows_without(batch, known, keys)


def changed_rows(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key has an open version with another (or no) hash."""
    stored = _stored_summary(_keyed_current(table, batch, keys), keys, partitioned=False)
    joined = salted_left_join(batch.where(has_full_key(keys)), stored, keys)
    differs = F.col("_low0").isNotNull() & ~F.coalesce(_same_hash(), F.lit(False))
    return joined.where(differs).select(*[col(c) for c in batch.columns])


def affected_partitions(
    classified: DataFrame, table: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """The partitions a classified batch touches, one row each, as ``pKey``: those
    that hold open versions of its changed keys, and the one it is loaded into.

    The tags name the lowest and the highest partition of a key. With ``table``
    and ``keys`` those in between are looked up too, for changed keys with more
    than two open versions.
    """
    places = F.explode(F.array(col(P_KEY), col(FIRST_P_KEY), col(PARTITION)))
    touched = classified.select(places.alias(P_KEY))
    if table is not None:
        scattered = classified.where(col(OPEN_VERSIONS) > 2)
        few = few_keys(scattered, keys)
        current = current_snapshot(table).select(*[col(k) for k in keys], PARTITION)
        if few is not None:
            between = current.join(few, list(keys), "left_semi")
        else:
            between = rows_with(current, scattered.select(*[col(k) for k in keys]).distinct(), keys)
        touched = touched.union(between.select(PARTITION))
    return touched.distinct()
