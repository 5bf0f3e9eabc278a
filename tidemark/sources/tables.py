"""Scans and sinks: landed files, stored tables, partitions."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from hashlib import sha256
from math import ceil
from uuid import uuid4

from pyspark.sql import Column, DataFrame, DataFrameReader, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import CURRENT, EFFECTIVE, HASH, PARTITION, col
from tidemark.operators.merge import MergeParts
from tidemark.sources.buckets import bucket_count, bucketed_scan, by_bucket, note_buckets, write_bucketed
from tidemark.sources.extracts import Extracts, literal
from tidemark.sources.filesystem import Content, Directory
from tidemark.sources.formats import (
    judged_columns,
    landed_struct,
    landing_options,
    spark_format,
    table_options,
    typed_columns,
    writable,
)
from tidemark.sources.snapshots import KEEP, VERSION, Snapshot, Snapshots, has_snapshots, place_path, write_version
from tidemark.spec import DELTA, TEXT_FORMATS, TableSpec

TARGET_FILE_BYTES = 128 * 1024 * 1024
# a partition is rewritten into fewer files once it has this many times too many
FILE_EXCESS = 4
# tasks per partition, at least, where adaptive execution is off and cannot split one itself
LEAST_SPLIT = 32


def _landed(spark: SparkSession, spec: TableSpec, base: str, files: Sequence[str] | None) -> DataFrame:
    reader = _reader(spark, spec.landing_format, landed_struct(spec)).options(**landing_options(spec))
    return reader.load(spec.landing_path(base) if files is None else [literal(f) for f in files])


def read_landing(spark: SparkSession, spec: TableSpec, base: str, files: Sequence[str] | None = None) -> DataFrame:
    """The landed files that match the spec's glob, or the named ones of them, under its
    explicit schema."""
    raw = spec.raw_struct
    landed = _landed(spark, spec, base, files)
    return landed.select(*typed_columns(raw, spec.bad_rows)) if spec.landing_format in TEXT_FORMATS else landed


def read_landing_judged(spark: SparkSession, spec: TableSpec, base: str, files: Sequence[str] | None = None) -> DataFrame:
    """Every landed row with its file, its text and the reasons why it is refused, if any;
    values that are none of their type are NULL."""
    return _landed(spark, spec, base, files).select(*judged_columns(spec.raw_struct, spec.landing_delimiter))


def reject_folder(spark: SparkSession, path: str) -> str:
    """Where the refused rows of a table's landed files are kept, a folder for each run."""
    return Directory(spark, path).sibling("__rejects")


def _reader(spark: SparkSession, name: str, schema: StructType) -> DataFrameReader:
    reader = spark.read.format(spark_format(name))
    return reader if name == DELTA else reader.schema(schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    return Directory(spark, path).exists()


def partition_folder(spark: SparkSession, spec: TableSpec, path: str) -> str:
    """How the table's partition folders are named: as those that are there, whatever
    their case, else as the spec says. A table with two spellings is refused."""
    table = Directory(spark, path)
    any_case = "".join(f"[{c.lower()}{c.upper()}]" for c in PARTITION)
    count, first = table.names(f"{any_case}=*", most=1)
    if not count:
        return spec.partition_folder
    name = first[0].partition("=")[0]
    if table.names(f"{name}=*", most=0)[0] != count:
        raise ValueError(f"{path} has partition folders under several spellings of {PARTITION}")
    return name


def read_final(spark: SparkSession, spec: TableSpec, path: str, snapshot: int | None = None) -> DataFrame:
    """The whole stored table: all partitions, all versions. Of a table with snapshots the
    latest one, or that of a number that is still kept."""
    held = Snapshots(spark, path).read(snapshot)
    if held is not None:
        return _read_places(spark, spec, path, held.paths(Directory(spark, path).path))
    if snapshot is not None:
        raise ValueError(f"{path} keeps no snapshots")
    schema = spec.final_struct
    stored = {c: c for c in schema.fieldNames()}
    if spec.partitioned and spec.table_format != DELTA:
        stored[PARTITION] = partition_folder(spark, spec, path)
        schema = StructType([StructField(stored[f.name], f.dataType) for f in schema])
    buckets = bucket_count(spark, spec, path)
    if buckets is not None and table_exists(spark, path):
        table = bucketed_scan(spark, spec, path, schema, buckets)
    else:
        table = _reader(spark, spec.table_format, schema).options(**table_options(spec)).load(path)
    return table.select(*[col(name).alias(c) for c, name in stored.items()])


def read_partitions(
    spark: SparkSession, spec: TableSpec, path: str, partitions: Iterable[int]
) -> DataFrame:
    """The named partitions only: other directories are pruned before listing files."""
    held = Snapshots(spark, path).read()
    if held is not None:
        folder = partition_folder(spark, spec, path)
        return _read_places(spark, spec, path, held.paths(Directory(spark, path).path, [f"{folder}={int(p)}" for p in partitions]))
    return read_final(spark, spec, path).where(col(PARTITION).isin([int(p) for p in partitions]))


def _read_places(spark: SparkSession, spec: TableSpec, path: str, places: Sequence[str]) -> DataFrame:
    if not places:
        return empty_table(spark, spec)
    stored = {c: c for c in spec.final_struct.fieldNames()}
    if spec.partitioned:
        stored[PARTITION] = partition_folder(spark, spec, path)
    fields = [StructField(stored[f.name], f.dataType) for f in spec.final_struct]
    schema = StructType([*fields, StructField(VERSION, StringType())])
    options = table_options(spec) | {"basePath": Directory(spark, path).path}
    table = _reader(spark, spec.table_format, schema).options(**options).load(list(places))
    return table.select(*[col(name).alias(c) for c, name in stored.items()])


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.final_struct)


def partition_path(path: str, partition: int, folder: str = PARTITION) -> str:
    return f"{path.rstrip('/')}/{folder}={int(partition)}"


def _writer(df: DataFrame, spec: TableSpec, mode: str) -> DataFrameWriter:
    return (
        writable(df, spec)
        .write.format(spark_format(spec.table_format))
        .options(**table_options(spec))
        .mode(mode)
    )


def _capped(df: DataFrame, spec: TableSpec) -> DataFrame:
    """At most ``files_per_partition`` files, when the spec asks for a limit."""
    n = spec.files_per_partition
    if n is None:
        return df
    if PARTITION not in df.columns:
        return df.repartition(n)
    return df.repartition(col(PARTITION), _slot(n))


def _slot(n: int) -> Column:
    """Spreads the rows of a partition over ``n``, versions of one key included."""
    return F.pmod(F.xxhash64(col(HASH), col(EFFECTIVE)), F.lit(n))


def _gathered(df: DataFrame, largest: int = 0) -> DataFrame:
    """``df`` shuffled by table partition, with large partitions split over tasks.
    Where adaptive execution is off, each is split alike: for ``largest`` bytes."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() == "true":
        return df.hint("rebalance", col(PARTITION))
    return df.repartition(col(PARTITION), _slot(max(LEAST_SPLIT, ceil(largest / TARGET_FILE_BYTES))))


def save_rows(
    df: DataFrame, spec: TableSpec, path: str, partition_key: int | None = None, extracts: Extracts | None = None
) -> None:
    """Plain load with the spec's save mode.

    In a partitioned table the mode applies to the run's partition: overwrite
    replaces that directory (even by nothing), append adds files to it, ignore
    and errorifexists ask whether it is there. With ``extracts`` the files are written
    next to the table and moved in, and the ledger follows, as one publish that a later
    load finishes.
    """
    if spec.files_per_partition is not None:
        df = df.repartition(spec.files_per_partition)
    if spec.table_format == DELTA:
        _save_delta(df, spec, path, [partition_key], spec.save_mode)
        return
    place, top = "", path
    if spec.partitioned:
        path = partition_path(path, partition_key, partition_folder(df.sparkSession, spec, path))
        place = path.rpartition("/")[2]
        df = df.drop(PARTITION)
    if extracts is not None:
        _save_by_moves(df, spec, top, place, extracts)
        return
    _writer(df, spec, spec.save_mode).save(path)


def _save_by_moves(df: DataFrame, spec: TableSpec, path: str, place: str, extracts: Extracts) -> None:
    spark = df.sparkSession
    recover_table(spark, path)
    table = Directory(spark, path)
    staged = table.sibling("__next")
    whole = f"{staged}/{place}" if place else staged
    _writer(df, spec, "overwrite").save(whole)
    if spec.save_mode == "overwrite":
        moves = [(place, *table.content(whole))]
    else:
        names = [f"{place}/{name}" if place else name for name in table.names("part-*", folder=whole)[1]]
        moves = [(name, *table.content(f"{staged}/{name}")) for name in names]
    _swap_in(spark, path, moves, extracts)


def _save_delta(
    df: DataFrame, spec: TableSpec, path: str, partitions: Sequence[int], mode: str = "overwrite"
) -> None:
    """Delta tables keep their own log: they are overwritten through it, in place,
    whole or by partition. Never run here, for want of Delta's jar."""
    writer = _writer(df, spec, mode)
    if spec.partitioned:
        writer = writer.partitionBy(PARTITION)
        if mode == "overwrite" and table_exists(df.sparkSession, path):
            listed = ", ".join(str(int(p)) for p in partitions)
            writer = writer.option("replaceWhere", f"{PARTITION} IN ({listed})")
    writer.save(path)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a publish that was cut off, or clear away one that was not yet decided.

    New content lies next to the table until a note, written last, says that it is
    whole and what goes where. From then on the publish is rolled forward: each move
    is repeated until its target holds as many files and bytes as the note says. At
    any time either the staged copy or the target is whole, also on stores where a
    rename copies and then deletes; which of them is, their contents tell. Nothing is
    deleted before. Without a note the table was not touched.
    """
    table = Directory(spark, path)
    staged, note = table.sibling("__next"), table.sibling("__swap")
    if not table.exists(note):
        # an old copy from before there were notes: all that is left of its table
        previous = table.sibling("__prev")
        if table.exists(previous) and not table.exists():
            table.rename(previous, table.path)
        table.delete(staged)
        return
    for place, *content in json.loads(table.read(note)):
        if isinstance(place, list):  # what goes with the table: from where to where
            source, target = place
        else:
            source, target = (f"{top}/{place}" if place else top for top in (staged, table.path))
        if not content:
            table.delete(target)
        elif table.exists(source) and table.content(source) == tuple(content):
            table.delete(target)
            if place:
                table.make(target.rpartition("/")[0])
            table.rename(source, target)
        elif table.content(target) != tuple(content):
            raise RuntimeError(f"neither {source} nor {target} is whole; nothing was deleted")
    table.delete(staged)
    table.delete(note)
    spark.catalog.refreshByPath(path)


def _swap_in(spark: SparkSession, path: str, moves: Sequence[tuple], extracts: Extracts | None = None) -> None:
    """``moves``: (place, files, bytes) for what is staged, (place,) for what goes."""
    table = Directory(spark, path)
    listed = [list(m) for m in moves]
    if extracts is not None:
        listed += [[[m.source, m.target], m.files, m.size] for m in extracts.moves()]
    table.write(table.sibling("__swap"), json.dumps(listed))
    recover_table(spark, path)


def settle_extracts(spark: SparkSession, path: str, extracts: Extracts) -> None:
    """Adds a load's files to the ledger where the table needs no publish, or had it."""
    _swap_in(spark, path, [], extracts)


def replace_table(df: DataFrame, spec: TableSpec, path: str, extracts: Extracts | None = None) -> None:
    """Replace the whole table by ``df``, which may read that very table.

    The new content is written next to the table, noted as whole, and moved into its
    place; `recover_table` finishes a move that was cut off.
    """
    spark = df.sparkSession
    if spec.table_format == DELTA:
        _writer(_capped(df, spec), spec, "overwrite").save(path)
        return
    recover_table(spark, path)
    table = Directory(spark, path)
    if has_snapshots(spark, spec, path):
        held, snapshots, folder = _begin_snapshot(spark, spec, path)
        if spec.partitioned:
            df = _capped(df, spec) if spec.files_per_partition is not None else _gathered(df, table.content().size)
        else:
            df = _capped(df, spec)
        version = snapshots.new_version()
        write_version(df, spec, table.path, version, folder)
        _commit(snapshots, held, dict.fromkeys(snapshots.written(version, folder), version), version, extracts)
        return
    staged = table.sibling("__next")
    if spec.buckets is not None:
        folder = partition_folder(spark, spec, path) if spec.partitioned else None
        write_bucketed(by_bucket(df, spec, spec.buckets), spec, staged, spec.buckets, folder)
        note_buckets(spark, spec, staged, spec.buckets)
    elif not spec.partitioned:
        _writer(_capped(df, spec), spec, "overwrite").save(staged)
    else:
        df = _capped(df, spec) if spec.files_per_partition is not None else _gathered(df, table.content().size)
        _partition_writer(df, spec, partition_folder(spark, spec, path)).save(staged)
    _swap_in(spark, path, [("", *table.content(staged))], extracts)


def _commit(
    snapshots: Snapshots, held: Snapshot, places: dict[str, str], version: str, extracts: Extracts | None
) -> None:
    if extracts is not None:
        extracts.by_version(version)
    snapshots.commit(held, places)
    if extracts is not None:
        settle_extracts(extracts.spark, snapshots.path, extracts)


def _begin_snapshot(spark: SparkSession, spec: TableSpec, path: str) -> tuple[Snapshot, Snapshots, str | None]:
    snapshots = Snapshots(spark, path)
    snapshots.clean(spec.snapshots or KEEP)
    return snapshots.start(), snapshots, partition_folder(spark, spec, path) if spec.partitioned else None


def _partition_writer(df: DataFrame, spec: TableSpec, folder: str) -> DataFrameWriter:
    return _writer(df.withColumnRenamed(PARTITION, folder), spec, "overwrite").partitionBy(folder)


def replace_table_parts(parts: MergeParts, spec: TableSpec, path: str, extracts: Extracts | None = None) -> None:
    df = parts.union()
    if spec.scd_type == 2 and spec.files_per_partition is None and spec.buckets is None:
        df = df.sortWithinPartitions(col(CURRENT))
    replace_table(df, spec, path, extracts)


def publish_partitions(
    parts: MergeParts, spec: TableSpec, path: str, affected: Sequence[int], extracts: Extracts | None = None
) -> list[int]:
    """Replace the ``affected`` partitions by the merge result; returns those that lost
    their last row, and so go.

    The result must hold everything that those partitions shall hold. A table with
    snapshots takes it in and commits it in one step. Else it is written
    next to the table, noted as whole, and moved in partition by partition. Readers
    may see a part of them replaced meanwhile; a publish that is cut off is finished
    by the next load, whichever move it had reached, with no row lost or doubled.

    Rows that a key shuffle has mixed are shuffled once more, by partition, so
    that each partition gets few files; adaptive execution splits a partition
    that outweighs the others. Stored rows still in file order skip that, unless
    their partitions have gathered many small files.
    """
    spark = parts.moved.sparkSession
    if spec.table_format == DELTA:
        _save_delta(_capped(parts.union(), spec), spec, path, affected)
        return []
    recover_table(spark, path)
    table = Directory(spark, path)
    staged, folder = table.sibling("__next"), partition_folder(spark, spec, path)
    versioned = has_snapshots(spark, spec, path)
    if versioned:
        held, snapshots, _ = _begin_snapshot(spark, spec, path)
        places = {p: f"{folder}={int(p)}" for p in affected}
        stored = {p: place_path(table.path, places[p], held.places.get(places[p], "")) for p in affected}
    else:
        stored = {p: partition_path(table.path, p, folder) for p in affected}
    before = {p: table.content(stored[p]) for p in affected}
    largest = max((c.size for c in before.values()), default=0)

    buckets = bucket_count(spark, spec, path)
    crowded = too_many_files(before.values(), buckets or 1)
    if buckets is not None:
        if parts.in_place is None or crowded:
            df = by_bucket(parts.union(), spec, buckets)
        else:
            df = parts.in_place.unionByName(by_bucket(parts.moved, spec, buckets))
    elif spec.files_per_partition is not None:
        df = _capped(parts.union(), spec)
    elif parts.in_place is None or crowded:
        df = _gathered(parts.union(), largest)
    else:
        df = parts.in_place.unionByName(_gathered(parts.moved, largest))

    # sorted by flag within a file, a scan of open versions skips the pages of
    # closed ones, and the other way round
    if versioned:
        version = snapshots.new_version()
        write_version(df, spec, table.path, version, folder)
        staged_at = {p: place_path(table.path, places[p], version) for p in affected}
    elif buckets is not None:
        write_bucketed(df, spec, staged, buckets, folder)
    else:
        order = [PARTITION, CURRENT] if spec.scd_type == 2 else [PARTITION]
        _partition_writer(df.sortWithinPartitions(*order), spec, folder).save(staged)

    if not versioned:
        staged_at = {p: partition_path(staged, p, folder) for p in affected}
    after = {p: table.content(staged_at[p]) for p in affected}
    filled = [p for p in affected if after[p].files]
    if versioned:
        written, _ = table.names(f"{folder}=*/{VERSION}={version}", most=0)
    else:
        written, _ = table.names(f"{folder}=*", most=0, folder=staged)
    if written != len(filled):
        raise RuntimeError(f"the merge gave rows outside the partitions {list(affected)}; nothing published")
    emptied = [p for p in affected if before[p].files and not after[p].files]
    if emptied and spec.scd_type == 2:
        raise RuntimeError(f"Type 2 merge gave no rows for partitions {emptied}; nothing removed")
    if versioned:
        kept = {place: v for place, v in held.places.items() if place not in places.values()}
        _commit(snapshots, held, kept | {places[p]: version for p in filled}, version, extracts)
        return emptied
    table.make()
    if buckets is not None:
        note_buckets(spark, spec, path, buckets)
    moves = [(f"{folder}={int(p)}", *after[p]) for p in filled]
    _swap_in(spark, path, moves + [(f"{folder}={int(p)}",) for p in emptied], extracts)
    return emptied


def too_many_files(contents: Iterable[Content], least: int = 1) -> bool:
    files = ideal = 0
    for content in contents:
        files += content.files
        ideal += max(least, ceil(content.size / TARGET_FILE_BYTES)) if content.files else 0
    return files > FILE_EXCESS * ideal


def shared_folder(spark: SparkSession, path: str | None = None) -> str:
    """Where rows may be parked within a run: the folder that the session names
    for checkpoints, else a hidden one next to the table."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if path is None:
        raise ValueError("the session names no spark.checkpoint.dir")
    return Directory(spark, path).sibling("__work")


def clear_work(spark: SparkSession, path: str) -> None:
    """Removes what a load that crashed has left in the hidden folder next to its table,
    and of this table's rows in the folder that the session names. Under the writer's lock."""
    table = Directory(spark, path)
    table.delete(table.sibling("__work"))
    shared = Directory(spark, shared_folder(spark, path))
    for name in shared.names(f"{_staged_prefix(table)}*", folder=literal(shared.path))[1]:
        shared.delete(f"{shared.path}/{name}")


def _staged_prefix(table: Directory) -> str:
    """Begins the names of folders with staged rows of one table."""
    return f"tidemark-{sha256(table.path.encode()).hexdigest()[:16]}-"


class Staged:
    """Rows written to the shared folder and read back: the end of their lineage.

    Written once, they survive lost executors, cannot come out differently when
    read again, and have a size that Catalyst knows. ``seen`` are aggregates that are
    observed while they are written, and cost no job of their own. Removed on leaving.
    """

    def __init__(self, df: DataFrame, path: str, **seen: Column):
        self._df = df
        self._asked = {name: c.alias(name) for name, c in seen.items()}
        self.seen: dict = {}
        spark = df.sparkSession
        prefix = _staged_prefix(Directory(spark, path))
        self._dir = Directory(spark, f"{shared_folder(spark, path)}/{prefix}{uuid4().hex}")

    def __enter__(self) -> DataFrame:
        try:
            self.seen = write_observed(self._df, self._dir.path, self._asked)
        except BaseException:
            self._dir.delete()
            raise
        return self._df.sparkSession.read.schema(self._df.schema).parquet(self._dir.path)

    def __exit__(self, *_exc) -> None:
        self._dir.delete()


def write_observed(df: DataFrame, path: str, seen: dict[str, Column]) -> dict:
    """Writes ``df`` as Parquet; returns the aggregates ``seen`` of what was written."""
    if not seen:
        df.write.parquet(path)
        return {}
    # at the top of the plan, so each row is counted in the task that writes it, once
    observation = Observation()
    df.observe(observation, *[c.alias(name) for name, c in seen.items()]).write.parquet(path)
    return observation.get
