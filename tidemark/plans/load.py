"""The load job: landed files to stored table, by the table's SCD type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import col, list_name, parse_run_date, with_audit
from tidemark.operators import (
    affected_partitions,
    classify_changes,
    dedupe_batch,
    heavy_of,
    key_sketch,
    scd1_parts,
    scd2_parts,
)
from tidemark.operators.changes import CHANGED, FIRST_P_KEY, NEW, OPEN_VERSIONS, P_KEY, ROW_TYPE
from tidemark.operators.merge import MergeParts
from tidemark.sources import (
    Extracts,
    Staged,
    WriterLock,
    clear_work,
    empty_table,
    index_partitions,
    note_lists,
    over_shared,
    publish_partitions,
    read_candidates,
    read_final,
    read_landing,
    read_landing_judged,
    read_partitions,
    recover_table,
    replace_table_parts,
    save_rows,
    settle_extracts,
    table_exists,
    with_known,
)
from tidemark.sources.buckets import bucket_count, by_bucket
from tidemark.sources.formats import REASONS, rejects
from tidemark.sources.tables import reject_folder
from tidemark.spec import TableSpec


@dataclass(frozen=True)
class BaseDirs:
    """Roots of the landed files and of the stored tables."""

    landing: str
    tables: str


@dataclass(frozen=True)
class LoadResult:
    path: str
    new: int | None = None
    changed: int | None = None
    affected: tuple[int, ...] = field(default=())
    emptied: tuple[int, ...] = field(default=())
    rejected: int = 0
    # landed files that were loaded, where the table has a ledger of them
    extracts: int | None = None


def run_load(
    spark: SparkSession,
    spec: TableSpec,
    dirs: BaseDirs,
    run_date: date | str,
    partition_key: int | None = None,
) -> LoadResult:
    """Read the landed batch of ``spec`` and load it. With ``bad_rows="quarantine"`` rows
    that hold a value of no type of theirs go to the table's reject folder, and the
    others are loaded. With ``ledger`` only landed files that the table does not hold yet
    are read: a name, size or time is new. Files, refused rows and table are
    committed by one publish, so a load that is cut off neither skips a file nor
    loads it twice."""
    path = spec.table_path(dirs.tables)
    if not spec.ledger and spec.bad_rows != "quarantine":
        return load_batch(spark, spec, read_landing(spark, spec, dirs.landing), path, run_date, partition_key)
    with WriterLock(spark, path) as lock:
        _prepare(spark, path)
        if not spec.ledger:
            return _load_landed(spark, spec, dirs, path, run_date, partition_key, lock)
        # listed within the lock: what another load has taken is in the ledger
        extracts = Extracts(spark, path, parse_run_date(run_date))
        files = extracts.begin(spec.landing_path(dirs.landing))
        if not files:
            extracts.drop()
            return LoadResult(path, 0, 0, extracts=0)
        result = _load_landed(spark, spec, dirs, path, run_date, partition_key, lock, extracts, files)
        return replace(result, extracts=len(files))


def _load_landed(
    spark: SparkSession,
    spec: TableSpec,
    dirs: BaseDirs,
    path: str,
    run_date: date | str,
    partition_key: int | None,
    lock: WriterLock,
    extracts: Extracts | None = None,
    files: list[str] | None = None,
) -> LoadResult:
    if spec.bad_rows != "quarantine":
        landed = read_landing(spark, spec, dirs.landing, files)
        return _load_rows(spark, spec, landed, path, run_date, partition_key, lock, extracts)
    judged = read_landing_judged(spark, spec, dirs.landing, files)
    # both outputs come of one pass over the landed files
    staged = Staged(judged, path, rejected=F.count_if(F.size(REASONS) > 0))
    with staged as rows:
        good = rows.where(F.size(REASONS) == 0).select(*[col(f.name) for f in spec.raw_struct])
        if staged.seen["rejected"] and extracts is not None:
            rejects(rows).write.parquet(extracts.reject_path())
        result = _load_rows(spark, spec, good, path, run_date, partition_key, lock, extracts)
        if staged.seen["rejected"] and extracts is None:
            folder = f"{reject_folder(spark, path)}/runDate={parse_run_date(run_date).isoformat()}"
            rejects(rows).write.mode("overwrite").parquet(folder)
    return replace(result, rejected=staged.seen["rejected"])


def _prepare(spark: SparkSession, path: str) -> None:
    """Finishes or clears away what an earlier load was cut off in."""
    recover_table(spark, path)
    clear_work(spark, path)


def load_batch(
    spark: SparkSession,
    spec: TableSpec,
    landed: DataFrame,
    path: str,
    run_date: date | str,
    partition_key: int | None = None,
) -> LoadResult:
    """Load the rows of ``landed`` into the table at ``path``.

    A publish that an earlier load was cut off in is finished first, so loading a batch
    again changes nothing. Keys that are missing from the batch
    stay as they are: a batch is an increment, not a full copy. While it runs it holds the
    table's lock; a second load fails at once.
    """
    _stamp(spec, partition_key)
    with WriterLock(spark, path) as lock:
        if spec.scd_type != 0:
            _prepare(spark, path)
        return _load_rows(spark, spec, landed, path, run_date, partition_key, lock)


def _stamp(spec: TableSpec, partition_key: int | None) -> int | None:
    if spec.partitioned and partition_key is None:
        raise ValueError("a partitioned table needs a partition key for the run")
    return int(partition_key) if spec.partitioned else None


def _load_rows(
    spark: SparkSession,
    spec: TableSpec,
    landed: DataFrame,
    path: str,
    run_date: date | str,
    partition_key: int | None,
    lock: WriterLock,
    extracts: Extracts | None = None,
) -> LoadResult:
    run_date, stamp = parse_run_date(run_date), _stamp(spec, partition_key)
    name = list_name(spec.columns, spec.hash_mode) if spec.versioned_hash else ""

    def audited(rows: DataFrame) -> DataFrame:
        return with_audit(rows, spec.columns, run_date, stamp, spec.hash_mode, name)

    if spec.scd_type == 0:
        save_rows(spec.as_stored(audited(landed)), spec, path, stamp, extracts)
        return LoadResult(path)
    return _load(spark, spec, landed, audited, path, run_date, stamp, lock, extracts)


def _load(
    spark: SparkSession,
    spec: TableSpec,
    landed: DataFrame,
    audited: Callable[[DataFrame], DataFrame],
    path: str,
    run_date: date,
    stamp: int | None,
    lock: WriterLock,
    extracts: Extracts | None,
) -> LoadResult:
    exists = table_exists(spark, path)
    table = read_final(spark, spec, path) if exists else empty_table(spark, spec)
    buckets = bucket_count(spark, spec, path)
    if buckets is not None and spec.may_repeat:
        raise ValueError(f"{path} is bucketed by key: rows of repeated or NULL keys cannot be kept in it")
    unique = spec.on_duplicate_keys != "keep"
    nulls = spec.null_key_policy
    keys = spec.table_keys
    landed = landed.select(*[col(c) for c in spec.columns])
    deduped = dedupe_batch(landed, spec.keys, spec.on_duplicate_keys, spec.dedupe_by, nulls)
    # classification reads the batch twice, the merge what is classified: each is
    # parsed, checked and hashed once, and what the plans ask of it is seen on the way
    lists = note_lists(spark, spec, path, exists) if spec.versioned_hash else []
    rows = with_known(spec, audited(deduped), lists) if lists else spec.as_stored(audited(deduped))
    asked = {"rows": F.count(F.lit(1))}
    if not unique:
        asked["sketch"] = key_sketch(rows, keys)
    batch = Staged(rows, path, **asked)
    with batch as landed_rows:
        landed_rows = by_bucket(landed_rows, spec, buckets)
        heavy = None if unique else heavy_of(batch.seen["sketch"])
        known = table
        if exists and spec.partitioned and spec.key_index:
            known = read_candidates(spark, spec, path, landed_rows, batch.seen["rows"])
        classified = classify_changes(
            landed_rows, over_shared(spec, known, lists), keys, nulls, unique_keys=unique, batch_rows=batch.seen["rows"], heavy=heavy
        )
        staged = Staged(classified, path, **tally(classified))
        with staged as changes:
            found = Tally.of(staged.seen)
            changes = by_bucket(changes, spec, buckets)
            lock.check()
            held = table if exists else None
            return _publish(spark, spec, path, held, changes, found, run_date, stamp, buckets is not None, extracts)


def _publish(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    table: DataFrame | None,
    staged: DataFrame,
    found: Tally,
    run_date: date,
    stamp: int | None,
    unique: bool,
    extracts: Extracts | None,
) -> LoadResult:
    new, changed = found.new, found.changed
    if new + changed == 0 and table is not None:
        if extracts is not None:
            settle_extracts(spark, path, extracts)
        return LoadResult(path, 0, 0)
    held = empty_table(spark, spec) if table is None else table
    if not spec.partitioned:
        replace_table_parts(_merge(spec, held, staged, run_date, changed, unique), spec, path, extracts)
        return LoadResult(path, new, changed)
    touched = found.touched
    if found.scattered:
        touched = {r[0] for r in affected_partitions(staged, held, spec.table_keys).collect()}
    affected = sorted({*touched, stamp})
    if table is not None:
        held = read_partitions(spark, spec, path, affected)
    emptied = publish_partitions(_merge(spec, held, staged, run_date, changed, unique), spec, path, affected, extracts)
    if spec.key_index:
        index_partitions(spark, spec, path, affected)
    return LoadResult(path, new, changed, tuple(affected), tuple(emptied))


def _merge(
    spec: TableSpec, table: DataFrame, staged: DataFrame, run_date: date, changed: int, unique: bool
) -> MergeParts:
    """What the batch's keys are says nothing about the table's: earlier loads may have
    kept any number of a key, so the table's own are looked at before they are shuffled.
    Not so in a bucketed table, which no load may have kept them in (``unique``)."""
    if spec.scd_type == 1:
        return scd1_parts(table, staged, spec.table_keys, unique, changed)
    return scd2_parts(table, staged, spec.table_keys, run_date, spec.close_scope, unique, changed)


def tally(classified: DataFrame) -> dict[str, Column]:
    """What is to be seen of a classified batch while it is written: its rows by type
    and, of a partitioned table, the partitions of their open versions (as many numbers
    as it has partitions, at most) and the most open versions of a key."""
    of_type = lambda t: F.count_if(F.col(ROW_TYPE) == t)
    asked = {"new": of_type(NEW), "changed": of_type(CHANGED)}
    if P_KEY in classified.columns:
        asked |= {name: F.array_join(F.collect_set(name), ",") for name in (P_KEY, FIRST_P_KEY)}
        asked[OPEN_VERSIONS] = F.max(OPEN_VERSIONS)
    return asked


@dataclass(frozen=True)
class Tally:
    new: int
    changed: int
    touched: frozenset[int]
    scattered: bool

    @classmethod
    def of(cls, seen: dict) -> Tally:
        places = ",".join(filter(None, (seen.get(P_KEY), seen.get(FIRST_P_KEY))))
        touched = frozenset(int(p) for p in places.split(",") if p)
        return cls(seen["new"], seen["changed"], touched, (seen.get(OPEN_VERSIONS) or 0) > 2)
