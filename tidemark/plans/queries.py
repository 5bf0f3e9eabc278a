"""One query per operator, each over the whole of the tables in ``sf_dir``.

The operators that read or write files do so in a fresh folder and return what is
read back.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.functions import HASH, PARTITION, close_rows, col, row_hash, with_audit
from tidemark.operators import (
    MergeParts,
    affected_partitions,
    changed_rows,
    classify_changes,
    current_snapshot,
    dedupe_batch,
    new_rows,
    retained_rows,
    scd1_merge,
    scd2_merge,
    superseded_rows,
)
from tidemark.operators.changes import FIRST_P_KEY, OPEN_VERSIONS
from tidemark.plans.fixture import (
    CUSTOMER,
    FIRST_PARTITION,
    ORDERS,
    RUN_DATE,
    RUN_PARTITION,
    Source,
    audited_batch,
    base,
    landed_batch,
    spec_of,
    stored_table,
)
from tidemark.plans.load import BaseDirs, load_batch, run_load, tally
from tidemark.sources import (
    index_partitions,
    publish_partitions,
    read_candidates,
    read_final,
    read_landing,
    read_partitions,
    replace_table,
    save_rows,
    write_observed,
)
from tidemark.sources.filesystem import Directory
from tidemark.sources.tables import reject_folder

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY = "2024-01-01"
# the stored names and types of a table whose landed ones differ
RENAMED = "id bigint, name string, nation int, balance decimal(14,2), segment string"
ROUNDTRIP_FORMATS = ("csv", "orc", "parquet", "txt")


def scratch(spark: SparkSession) -> str:
    """A fresh folder on the session's shared store, its checkpoint folder or else its
    warehouse; removed when Spark ends."""
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = Directory(spark, f"{parent.rstrip('/')}/queries-{uuid4().hex}")
    folder.delete_on_exit()
    return folder.path


# --- scans and projections -------------------------------------------------


def _land(spark: SparkSession, batch: DataFrame, source: Source) -> str:
    """Two CSV extracts of ``batch``, and one of another name that no glob takes."""
    root = scratch(spark)
    even = col(source.key) % 2 == 0
    for name, rows in (
        ("extract_1", batch.where(even)),
        ("extract_2", batch.where(~even)),
        ("draft_1", batch),
    ):
        rows.write.option("header", True).csv(f"{root}/crm/{source.table}/{name}")
    return root


def _landing_spec(source: Source, scd_type: int = 2, **options):
    return spec_of(source, scd_type, app_dir="crm", table_dir=source.table, landing_pattern="extract_*/*.csv", **options)


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, _landing_spec(CUSTOMER), _land(spark, base(spark, sf_dir), CUSTOMER))


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed customers, some with text for a nation or a balance: what the load takes, and
    what goes to the table's reject folder, with the reasons."""
    key, sep = col(CUSTOMER.key), "; "
    texts = base(spark, sf_dir).withColumns(
        {
            "c_nationkey": F.when(key % 7 == 0, "n/a").otherwise(col("c_nationkey").cast("string")),
            "c_acctbal": F.when(key % 11 == 0, "12x").otherwise(col("c_acctbal").cast("string")),
        }
    )
    spec = _landing_spec(CUSTOMER, scd_type=1, bad_rows="quarantine")
    dirs = BaseDirs(_land(spark, texts, CUSTOMER), scratch(spark))
    run_load(spark, spec, dirs, RUN_DATE)
    path = spec.table_path(dirs.tables)
    taken = read_final(spark, spec, path).select(key.cast("string").alias("landed"), F.lit("").alias("reasons"))
    refused = spark.read.parquet(reject_folder(spark, path))
    return taken.unionByName(refused.select(F.col("row").alias("landed"), F.array_join("reasons", sep).alias("reasons")))


def raw_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _landing_spec(CUSTOMER, columns=("c_mktsegment", "c_custkey", "c_acctbal"))
    return read_landing(spark, spec, _land(spark, base(spark, sf_dir), CUSTOMER)).select(*spec.columns)


def _store(spark: SparkSession, rows: DataFrame, spec, path: str | None = None) -> str:
    path = path or f"{scratch(spark)}/{spec.name}"
    replace_table(rows.select(*spec.final_struct.fieldNames()), spec, path)
    return path


def final_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(CUSTOMER, partitioned=True)
    return read_final(spark, spec, _store(spark, stored_table(spark, sf_dir, whole=True), spec))


def final_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed as text throughout, stored under names and types of its own."""
    texts = ", ".join(f"{name} string" for name in CUSTOMER.names)
    spec = spec_of(CUSTOMER, raw_schema=texts, stored_schema=RENAMED, table_keys=("id",))
    landed = base(spark, sf_dir).select(*[col(name).cast("string") for name in CUSTOMER.names])
    path = f"{scratch(spark)}/customer"
    load_batch(spark, spec, landed, path, RUN_DATE)
    return read_final(spark, spec, path)


def final_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(CUSTOMER, partitioned=True)
    path = _store(spark, stored_table(spark, sf_dir, whole=True), spec)
    return read_partitions(spark, spec, path, [FIRST_PARTITION, FIRST_PARTITION + 1])


def format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    stored = stored_table(spark, sf_dir, whole=True)
    result = None
    for name in ROUNDTRIP_FORMATS:
        spec = spec_of(CUSTOMER, partitioned=True, table_format=name, table_delimiter="|")
        path = _store(spark, stored, spec, f"{root}/{name}")
        rows = read_final(spark, spec, path).withColumn("format", F.lit(name))
        result = rows if result is None else result.unionByName(rows)
    return result


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_audit(base(spark, sf_dir), CUSTOMER.names, RUN_DATE, RUN_PARTITION, "compat")


def _hashes(source: Source, mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        hashed = row_hash(source.names, mode).alias(HASH)
        return base(spark, sf_dir, source).select(source.key, hashed)

    return query


# --- change detection ------------------------------------------------------


def close_open_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return close_rows(current_snapshot(stored_table(spark, sf_dir, whole=True)), RUN_DATE)


def open_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_snapshot(stored_table(spark, sf_dir, whole=True))


def last_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with repeated composite keys, cut to the last shipped row of each."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    batch = lines.select(
        *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
    )
    return dedupe_batch(batch, ["l_orderkey", "l_linenumber"], "last", ["l_shipdate"])


def _classified(spark: SparkSession, sf_dir: str, source: Source) -> DataFrame:
    landed = dedupe_batch(landed_batch(spark, sf_dir, source), [source.key])
    batch = with_audit(landed, source.names, RUN_DATE, RUN_PARTITION, "compat")
    return classify_changes(batch, stored_table(spark, sf_dir, source), [source.key])


def _classify(source: Source) -> Query:
    return lambda spark, sf_dir: _classified(spark, sf_dir, source).drop(
        FIRST_P_KEY, OPEN_VERSIONS
    )


def classify_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the partitions alone that the key index names: those of history are not read."""
    spec = spec_of(CUSTOMER, partitioned=True, key_index=True)
    path = _store(spark, stored_table(spark, sf_dir), spec)
    stored = [r[0] for r in read_final(spark, spec, path).select(PARTITION).distinct().collect()]
    index_partitions(spark, spec, path, stored)
    landed = dedupe_batch(landed_batch(spark, sf_dir), [CUSTOMER.key])
    batch = with_audit(landed, CUSTOMER.names, RUN_DATE, RUN_PARTITION, "compat")
    known = read_candidates(spark, spec, path, batch)
    return classify_changes(batch, known, [CUSTOMER.key]).drop(FIRST_P_KEY, OPEN_VERSIONS)


# --- batches with repeated or missing keys ---------------------------------


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders as a batch keyed by customer, so keys repeat, and a stored table
    with the last order of every customer as its open version."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn(
        "o_custkey", F.col("o_custkey").cast("string")
    )
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    last = orders.groupBy("o_custkey").agg(
        *[F.max_by(c, "o_orderkey").alias(c) for c in columns[1:]]
    )
    return (
        with_audit(orders, columns, RUN_DATE, hash_mode="compat"),
        with_audit(last, columns, FIRST_DAY, hash_mode="compat"),
    )


def classify_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stored = _orders_by_customer(spark, sf_dir)
    return classify_changes(batch, stored, ["o_custkey"], unique_keys=False)


def _unkeyed(batch: DataFrame) -> DataFrame:
    """Every seventh customer's orders lose their key."""
    key = F.col("o_custkey")
    return batch.withColumn("o_custkey", F.when(key.cast("bigint") % 7 != 0, key))


def new_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stored = _orders_by_customer(spark, sf_dir)
    return new_rows(_unkeyed(batch), stored.where(F.col("o_custkey").cast("bigint") % 5 != 0), ["o_custkey"])


def classify_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key count as new."""
    batch, stored = _orders_by_customer(spark, sf_dir)
    batch = _unkeyed(batch)
    return classify_changes(batch, stored, ["o_custkey"], null_keys="keep", unique_keys=False)


def _repeated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stored table and the staged classification of a batch with repeated keys."""
    _, stored = _orders_by_customer(spark, sf_dir)
    path = f"{scratch(spark)}/classified"
    classify_repeated(spark, sf_dir).write.parquet(path)
    return stored, spark.read.parquet(path)


def merge_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, classified = _repeated(spark, sf_dir)
    return scd2_merge(stored, classified, ["o_custkey"], RUN_DATE, unique_keys=False)


def type1_merge_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, classified = _repeated(spark, sf_dir)
    return scd1_merge(stored, classified, ["o_custkey"], unique_keys=False)


def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_table(spark, sf_dir)
    return affected_partitions(_classified(spark, sf_dir, CUSTOMER), stored, [CUSTOMER.key])


def only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(audited_batch(spark, sf_dir), stored_table(spark, sf_dir), [CUSTOMER.key])


def only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_rows(audited_batch(spark, sf_dir), stored_table(spark, sf_dir), [CUSTOMER.key])


def retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = _classified(spark, sf_dir, CUSTOMER)
    return retained_rows(stored_table(spark, sf_dir), classified, [CUSTOMER.key])


def superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = _classified(spark, sf_dir, CUSTOMER)
    return superseded_rows(stored_table(spark, sf_dir), classified, [CUSTOMER.key], RUN_DATE)


# --- merges ----------------------------------------------------------------


def _staged(spark: SparkSession, sf_dir: str, source: Source) -> tuple[DataFrame, int]:
    """The classified batch, written once, since a merge reads it twice, and how many of
    its rows are changed ones, seen while they were written."""
    path = f"{scratch(spark)}/classified"
    classified = _classified(spark, sf_dir, source)
    seen = write_observed(classified, path, tally(classified))
    return spark.read.schema(classified.schema).parquet(path), seen["changed"]


def type1_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = current_snapshot(stored_table(spark, sf_dir))
    classified, changed = _staged(spark, sf_dir, CUSTOMER)
    return scd1_merge(stored, classified, [CUSTOMER.key], changed=changed)


def _type2_merge(source: Source, close_scope: str = "current") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = stored_table(spark, sf_dir, source)
        classified, changed = _staged(spark, sf_dir, source)
        return scd2_merge(stored, classified, [source.key], RUN_DATE, close_scope, changed=changed)

    return query


def _load(source: Source, scd_type: int, **options) -> Query:
    """Store the fixture, load the batch into it, read the table back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = spec_of(source, scd_type, **options)
        stored = stored_table(spark, sf_dir, source)
        if scd_type == 1:
            stored = current_snapshot(stored)
        path = _store(spark, stored, spec)
        batch = landed_batch(spark, sf_dir, source)
        load_batch(spark, spec, batch, path, RUN_DATE, RUN_PARTITION)
        return read_final(spark, spec, path)

    return query


LEGACY = {
    "partitioned": True,
    "partition_folder": "partitionkey",
    "table_format": "csv",
    "text_dialect": "plain",
}


def _legacy(scd_type: int) -> Query:
    """Load into a table as an older job has left it: CSV without header in lower-case
    partition folders, each row with its partition as a last field."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = spec_of(CUSTOMER, scd_type, **LEGACY)
        stored = stored_table(spark, sf_dir)
        stored = current_snapshot(stored) if scd_type == 1 else stored
        path = f"{scratch(spark)}/customer"
        last = col(PARTITION)
        rows = stored.withColumn("lastField", last).withColumnRenamed(PARTITION, "partitionkey")
        rows.write.partitionBy("partitionkey").csv(path)
        load_batch(spark, spec, landed_batch(spark, sf_dir), path, RUN_DATE, RUN_PARTITION)
        return read_final(spark, spec, path)

    return query


def merge_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table has other names than the landed batch, the key's too."""
    spec = spec_of(CUSTOMER, stored_schema=RENAMED, table_keys=("id",), partitioned=True)
    stored = stored_table(spark, sf_dir)
    path = _store(spark, stored.toDF(*spec.final_struct.fieldNames()).to(spec.final_struct), spec)
    load_batch(spark, spec, landed_batch(spark, sf_dir), path, RUN_DATE, RUN_PARTITION)
    return read_final(spark, spec, path)


def merge_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load cut off amid its publish, and repeated: one partition moved in, the next
    one deleted, the others as they were."""
    spec = spec_of(CUSTOMER, partitioned=True)
    stored, batch = stored_table(spark, sf_dir), landed_batch(spark, sf_dir)
    root = scratch(spark)
    path = _store(spark, stored, spec, f"{root}/customer")
    whole = _store(spark, stored, spec, f"{root}/uncut")
    affected = load_batch(spark, spec, batch, whole, RUN_DATE, RUN_PARTITION).affected
    table = Directory(spark, path)
    staged = table.sibling("__next")
    read_partitions(spark, spec, whole, affected).write.partitionBy(PARTITION).parquet(staged)
    places = [f"{PARTITION}={p}" for p in affected]
    moves = [(place, *table.content(f"{staged}/{place}")) for place in places]
    table.write(table.sibling("__swap"), json.dumps(moves))
    table.delete(f"{path}/{places[0]}")
    table.rename(f"{staged}/{places[0]}", f"{path}/{places[0]}")
    table.delete(f"{path}/{places[1]}")
    load_batch(spark, spec, batch, path, RUN_DATE, RUN_PARTITION)
    return read_final(spark, spec, path)


def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before the load, which its readers still have."""
    spec = spec_of(CUSTOMER, partitioned=True, snapshots=2)
    path = _store(spark, stored_table(spark, sf_dir), spec)
    load_batch(spark, spec, landed_batch(spark, sf_dir), path, RUN_DATE, RUN_PARTITION)
    return read_final(spark, spec, path, snapshot=1)


def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load into a table that does not exist yet."""
    spec = spec_of(CUSTOMER, partitioned=True)
    path = f"{scratch(spark)}/customer"
    load_batch(spark, spec, base(spark, sf_dir), path, RUN_DATE, RUN_PARTITION)
    return read_final(spark, spec, path)


def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the whole job over landed CSV files: first load, then changes."""
    spec = _landing_spec(CUSTOMER, partitioned=True, hash_mode="delimited")
    dirs = BaseDirs(_land(spark, landed_batch(spark, sf_dir), CUSTOMER), scratch(spark))
    first = base(spark, sf_dir).where(col(CUSTOMER.key) % 10 != 9)
    load_batch(spark, spec, first, spec.table_path(dirs.tables), FIRST_DAY, FIRST_PARTITION)
    run_load(spark, spec, dirs, RUN_DATE, RUN_PARTITION)
    return read_final(spark, spec, spec.table_path(dirs.tables))


def _first_extract(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder with the first extract of nine in ten customers."""
    root = scratch(spark)
    first = base(spark, sf_dir).where(col(CUSTOMER.key) % 10 != 9)
    first.write.option("header", True).csv(f"{root}/crm/{CUSTOMER.table}/extract_1")
    return root


def _incremental(first, second, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a landing folder that keeps its files: the first extract, one that
    has joined it, and none. Each is loaded once."""
    dirs = BaseDirs(_first_extract(spark, sf_dir), scratch(spark))
    run_load(spark, first, dirs, FIRST_DAY, FIRST_PARTITION)
    landed_batch(spark, sf_dir).select(*second.raw_struct.fieldNames()).write.option("header", True).csv(
        f"{dirs.landing}/crm/{CUSTOMER.table}/extract_2"
    )
    run_load(spark, second, dirs, RUN_DATE, RUN_PARTITION)
    run_load(spark, second, dirs, RUN_DATE, RUN_PARTITION + 1)
    return read_final(spark, second, second.table_path(dirs.tables))


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _landing_spec(CUSTOMER, partitioned=True, hash_mode="delimited", ledger=True)
    return _incremental(spec, spec, spark, sf_dir)


def type0_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _landing_spec(CUSTOMER, 0, partitioned=True, ledger=True)
    return _incremental(spec, spec, spark, sf_dir)


def _column_change(before: Sequence[str], after: Sequence[str]) -> Query:
    """First load under some columns, the changes under others."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, then = (spec_of(CUSTOMER, columns=tuple(names), partitioned=True, versioned_hash=True) for names in (before, after))
        path = f"{scratch(spark)}/customer"
        stored = base(spark, sf_dir).where(col(CUSTOMER.key) % 10 != 9)
        load_batch(spark, first, stored, path, FIRST_DAY, FIRST_PARTITION)
        load_batch(spark, then, landed_batch(spark, sf_dir).select(*after), path, RUN_DATE, RUN_PARTITION)
        return read_final(spark, then, path)

    return query


# --- plain loads and partition writes --------------------------------------


def _type0(save_mode: str, runs: Sequence[int], partitioned: bool) -> Query:
    """Load the base rows, then the batch, each under ``save_mode``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = spec_of(CUSTOMER, 0, partitioned=partitioned, save_mode=save_mode)
        path = f"{scratch(spark)}/customer"
        load_batch(spark, spec, base(spark, sf_dir), path, FIRST_DAY, runs[0])
        load_batch(spark, spec, landed_batch(spark, sf_dir), path, RUN_DATE, runs[1])
        return read_final(spark, spec, path)

    return query


def type0_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite replaces the run's partition and leaves the others alone."""
    spec = spec_of(CUSTOMER, 0, partitioned=True, save_mode="overwrite")
    path = f"{scratch(spark)}/customer"
    rows = base(spark, sf_dir)
    for run_date, partition, batch in (
        (FIRST_DAY, FIRST_PARTITION, rows),
        (FIRST_DAY, RUN_PARTITION, rows),
        (RUN_DATE, RUN_PARTITION, landed_batch(spark, sf_dir)),
    ):
        audited = with_audit(batch, spec.columns, run_date, partition, spec.hash_mode)
        save_rows(audited, spec, path, partition)
    return read_final(spark, spec, path)


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrite two partitions of a table from their own rows, one of them to nothing."""
    spec = spec_of(CUSTOMER, 1, partitioned=True)
    path = _store(spark, stored_table(spark, sf_dir, whole=True), spec)
    affected = [FIRST_PARTITION, FIRST_PARTITION + 1]
    held = read_partitions(spark, spec, path, affected)
    rewritten = held.where(col(PARTITION) == FIRST_PARTITION).withColumn(
        CUSTOMER.amount, F.lit(0).cast("decimal(12,2)")
    )
    publish_partitions(MergeParts(None, rewritten), spec, path, affected)
    return read_final(spark, spec, path)


def _shown(query: Query) -> Query:
    """Money as text in the result: its scale shows, and both engines write it alike."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = query(spark, sf_dir)
        money = [f.name for f in rows.schema if isinstance(f.dataType, DecimalType)]
        return rows.withColumns({name: col(name).cast("string") for name in money})

    return shown


_RESULTS: dict[str, Query] = {
    "landing_scan": landing_scan,
    "landing_rejects": landing_rejects,
    "raw_projection": raw_projection,
    "final_scan": final_scan,
    "final_scan_typed": final_scan_typed,
    "final_partition_scan": final_partition_scan,
    "format_roundtrip": format_roundtrip,
    "audit_columns": audit_columns,
    "row_hash": _hashes(CUSTOMER, "compat"),
    "row_hash_delimited": _hashes(CUSTOMER, "delimited"),
    "row_hash_orders": _hashes(ORDERS, "delimited"),
    "close_rows": close_open_rows,
    "current_snapshot": open_rows,
    "dedupe_batch": last_lineitems,
    "classify_changes": _classify(CUSTOMER),
    "classify_changes_orders": _classify(ORDERS),
    "classify_changes_indexed": classify_indexed,
    "scd2_merge_indexed": _load(CUSTOMER, 2, partitioned=True, key_index=True),
    "classify_changes_repeated_keys": classify_repeated,
    "classify_changes_null_keys": classify_null_keys,
    "affected_partitions": touched_partitions,
    "new_rows": only_new,
    "new_rows_null_keys": new_null_keys,
    "changed_rows": only_changed,
    "retained_rows": retained,
    "superseded_rows": superseded,
    "scd1_merge": type1_merge,
    "scd1_merge_partitioned": _load(CUSTOMER, 1, partitioned=True),
    "scd1_merge_table": _load(CUSTOMER, 1),
    "scd1_merge_repeated_keys": type1_merge_repeated,
    "scd1_merge_legacy_layout": _legacy(1),
    "scd2_merge": _type2_merge(CUSTOMER),
    "scd2_merge_orders": _type2_merge(ORDERS),
    "scd2_merge_all_versions": _type2_merge(CUSTOMER, "all"),
    "scd2_merge_repeated_keys": merge_repeated,
    "scd2_merge_partitioned": _load(CUSTOMER, 2, partitioned=True),
    "scd2_merge_partitioned_orders": _load(ORDERS, 2, partitioned=True),
    "scd2_merge_legacy_layout": _legacy(2),
    "scd2_merge_recovered": merge_recovered,
    "scd2_merge_renamed_keys": merge_renamed,
    "scd2_merge_table": _load(CUSTOMER, 2),
    "scd1_merge_bucketed": _load(CUSTOMER, 1, buckets=4),
    "scd2_merge_bucketed": _load(CUSTOMER, 2, buckets=4),
    "scd2_merge_bucketed_partitioned": _load(CUSTOMER, 2, buckets=4, partitioned=True),
    "snapshot_scan": snapshot_scan,
    "scd1_merge_snapshot": _load(CUSTOMER, 1, snapshots=2),
    "scd2_merge_snapshot": _load(CUSTOMER, 2, partitioned=True, snapshots=2),
    "scd2_merge_table_csv": _load(CUSTOMER, 2, table_format="csv"),
    "first_load": first_load,
    "ingest_job": ingest_job,
    "ingest_job_incremental": ingest_incremental,
    "scd2_merge_added_column": _column_change(CUSTOMER.names[:-1], CUSTOMER.names),
    "scd2_merge_removed_column": _column_change(CUSTOMER.names, CUSTOMER.names[:-1]),
    "type0_append_incremental": type0_incremental,
    "type0_append": _type0("append", (FIRST_PARTITION, FIRST_PARTITION), False),
    "type0_append_partitioned": _type0("append", (FIRST_PARTITION, RUN_PARTITION), True),
    "type0_ignore": _type0("ignore", (FIRST_PARTITION, FIRST_PARTITION), True),
    "type0_overwrite": type0_overwrite,
    "partition_overwrite": partition_overwrite,
}

QUERIES: dict[str, Query] = {name: _shown(query) for name, query in _RESULTS.items()}
