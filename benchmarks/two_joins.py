"""The same loads in another shape, for comparison: new and changed rows by two
joins, kept and closed rows by two more, everything through one output task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import close_rows, col
from tidemark.plans.fixture import (
    CUSTOMER,
    ORDERS,
    RUN_DATE,
    RUN_PARTITION,
    Source,
    audited_batch,
    spec_of,
    stored_table,
)
from tidemark.plans.queries import scratch
from tidemark.sources import read_final, replace_table
from tidemark.sources.tables import partition_path

Query = Callable[[SparkSession, str], DataFrame]


def _classify(batch: DataFrame, table: DataFrame, key: str) -> DataFrame:
    current = table.where("current = 'Y'").select(
        col(key).alias("_key"), F.col("rowHash").alias("_hash"), F.col("partitionKey").alias("_part")
    )
    joined = batch.join(current, batch[key] == current["_key"], "left")
    new = joined.where("_key IS NULL").withColumns(
        {"rowType": F.lit("NewRows"), "pKey": F.col("partitionKey")}
    )
    changed = joined.where("_key IS NOT NULL AND rowHash <> _hash").withColumns(
        {"rowType": F.lit("CurrentRows"), "pKey": F.col("_part")}
    )
    return new.unionByName(changed).drop("_key", "_hash", "_part")


def _kept(table: DataFrame, classified: DataFrame, key: str, scd_type: int) -> DataFrame:
    """The stored rows after the merge: one join to keep, for Type 2 another to close."""
    columns = table.columns
    changed = classified.where("rowType = 'CurrentRows'").select(col(key).alias("_key"))
    joined = table.join(changed, table[key] == changed["_key"], "left")
    kept = joined.where("_key IS NULL").select(*columns)
    if scd_type == 2:
        again = table.join(changed, table[key] == changed["_key"])
        closed = close_rows(again, RUN_DATE, F.col("current") == "Y")
        kept = kept.unionByName(closed.select(*columns))
    return kept


def _merge(table: DataFrame, classified: DataFrame, key: str, scd_type: int) -> DataFrame:
    incoming = classified.drop("rowType", "pKey")
    return _kept(table, classified, key, scd_type).unionByName(incoming).coalesce(1)


def _stored(spark: SparkSession, sf_dir: str, source: Source, scd_type: int) -> DataFrame:
    table = stored_table(spark, sf_dir, source)
    return table.where("current = 'Y'") if scd_type == 1 else table


def _pure(source: Source, scd_type: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _stored(spark, sf_dir, source, scd_type)
        classified = _classify(audited_batch(spark, sf_dir, source), table, source.key)
        return _merge(table, classified, source.key, scd_type)

    return query


def _classify_only(source: Source) -> Query:
    return lambda spark, sf_dir: _classify(
        audited_batch(spark, sf_dir, source), stored_table(spark, sf_dir, source), source.key
    )


def _by_partition(source: Source, scd_type: int) -> Query:
    """One write per touched partition, one after the other."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = spec_of(source, scd_type, partitioned=True)
        path = f"{scratch(spark)}/{source.table}"
        names = spec.final_struct.fieldNames()
        replace_table(_stored(spark, sf_dir, source, scd_type).select(*names), spec, path)
        classified = _classify(
            audited_batch(spark, sf_dir, source), read_final(spark, spec, path), source.key
        ).cache()
        touched = sorted({r[0] for r in classified.select("pKey").distinct().collect()} | {RUN_PARTITION})
        for partition in touched:
            held = read_final(spark, spec, path).where(F.col("partitionKey") == partition)
            if partition == RUN_PARTITION:
                merged = _merge(held, classified, source.key, scd_type)
            else:
                moved = classified.where(F.col("pKey") == partition)
                merged = _kept(held, moved, source.key, scd_type).coalesce(1)
            merged = merged.cache()
            merged.take(1)
            merged.drop("partitionKey").write.mode("overwrite").parquet(partition_path(path, partition))
            merged.unpersist()
        classified.unpersist()
        return read_final(spark, spec, path)

    return query


TWO_JOINS: dict[str, Query] = {
    "classify_changes:two_joins": _classify_only(CUSTOMER),
    "classify_changes_orders:two_joins": _classify_only(ORDERS),
    "scd1_merge:two_joins": _pure(CUSTOMER, 1),
    "scd2_merge:two_joins": _pure(CUSTOMER, 2),
    "scd2_merge_orders:two_joins": _pure(ORDERS, 2),
    "scd1_merge_partitioned:two_joins": _by_partition(CUSTOMER, 1),
    "scd2_merge_partitioned:two_joins": _by_partition(CUSTOMER, 2),
    "scd2_merge_partitioned_orders:two_joins": _by_partition(ORDERS, 2),
}
