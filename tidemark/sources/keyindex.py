"""Which partitions can hold a batch's keys: bounds and bit maps of each partition's open
versions, kept beside the table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import CURRENT, OPEN_FLAG, PARTITION, col
from tidemark.operators.changes import has_full_key
from tidemark.sources.filesystem import Directory
from tidemark.sources.tables import partition_folder, partition_path, read_final, read_partitions
from tidemark.spec import TableSpec

MAP_BITS = 1 << 24  # of a partition's map: 2 MB at most
HASHES = 2  # bits that a key sets
MOST_KEYS = MAP_BITS // 4  # open versions from which a map would let too much through
BATCH_KEYS = 200_000  # rows of a batch up to which the index is asked


def _folder(spark: SparkSession, path: str) -> Directory:
    return Directory(spark, Directory(spark, path).sibling("__keys"))


def _schema(spec: TableSpec) -> str:
    key = spec.final_struct[spec.table_keys[0]].dataType.simpleString()
    return f"stamp string, slots long, low {key}, high {key}, slot long, bits binary, {PARTITION} int"


def _stamp(table: Directory, place: str) -> str:
    """Names the files of a partition: Spark gives those of each write names of their own."""
    names = sorted(table.names("*", folder=place)[1])
    return hashlib.sha256("\n".join([*names, str(tuple(table.content(place)))]).encode()).hexdigest()


def _positions(keys: Iterable[str]) -> Column:
    of_one = [F.pmod(F.xxhash64(F.lit(n), *[col(k) for k in keys]), F.lit(MAP_BITS)) + 1 for n in range(HASHES)]
    return F.array(*of_one)


def index_partitions(spark: SparkSession, spec: TableSpec, path: str, partitions: Iterable[int]) -> None:
    """Indexes the named partitions anew, from their stored open versions.

    A partition has a row for each slot of its map that is in use, with its files' stamp
    and the number of slots, so that a row that is missing or of another time is
    noticed; a partition whose index is written half is taken as having none. One with
    more than MOST_KEYS open versions has its bounds alone.
    """
    partitions = sorted({int(p) for p in partitions})
    table, index = Directory(spark, path), _folder(spark, path)
    folder = partition_folder(spark, spec, path)
    there = [p for p in partitions if table.exists(partition_path(table.path, p, folder))]
    for p in partitions:
        index.delete(partition_path(index.path, p))
    if not there:
        return
    stamps = [(p, _stamp(table, partition_path(table.path, p, folder))) for p in there]
    stamps = spark.createDataFrame(stamps, f"{PARTITION} int, stamp string")
    keys, first = spec.table_keys, col(spec.table_keys[0])
    rows = read_partitions(spark, spec, path, there).where((col(CURRENT) == OPEN_FLAG) & has_full_key(keys))
    bounds = rows.groupBy(PARTITION).agg(F.min(first).alias("low"), F.max(first).alias("high"), F.count("*").alias("n"))
    bounds = stamps.join(bounds, PARTITION, "left")

    at = F.explode(_positions(keys)).alias("at")
    mapped = rows.join(F.broadcast(bounds.where(F.col("n") <= MOST_KEYS).select(PARTITION)), PARTITION, "left_semi")
    slots = mapped.select(PARTITION, at).groupBy(PARTITION, F.bitmap_bucket_number("at").alias("slot"))
    slots = slots.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    counted = slots.groupBy(PARTITION).agg(F.count("*").alias("slots"))
    heads = bounds.join(counted, PARTITION, "left").withColumn("slots", F.coalesce("slots", F.lit(0)))
    # a row without a slot says that the partition is known
    entries = heads.select("*", F.lit(0).cast("long").alias("slot"), F.lit(None).cast("binary").alias("bits"))
    entries = entries.unionByName(heads.join(slots, PARTITION))
    names = [c.split()[0] for c in _schema(spec).split(", ")]
    ahead = f"{index.path}_ahead"
    ordered = entries.select(*names).repartition(len(there), PARTITION).sortWithinPartitions(PARTITION, "slot")
    ordered.write.mode("overwrite").partitionBy(PARTITION).parquet(ahead)
    index.make()
    for p in there:
        index.rename(partition_path(ahead, p), partition_path(index.path, p))
    index.delete(ahead)


def partitions_with_keys(
    spark: SparkSession, spec: TableSpec, path: str, batch: DataFrame, rows: int | None = None
) -> list[int] | None:
    """The partitions that may hold open versions of the batch's keys; None where the
    index cannot tell, because there is none or the batch has too many rows.

    A partition that the index does not know as it is now counts as one that may.
    """
    table, index = Directory(spark, path), _folder(spark, path)
    if not index.exists() or (batch.count() if rows is None else rows) > BATCH_KEYS:
        return None
    folder = partition_folder(spark, spec, path)
    there = {int(name.partition("=")[2]) for name in table.names(f"{folder}=*")[1] if name.partition("=")[2].lstrip("-").isdigit()}
    entries = spark.read.schema(_schema(spec)).parquet(index.path)
    heads = entries.groupBy(PARTITION).agg(
        F.max("slots").alias("slots"), F.min("stamp").alias("stamp"), F.count("bits").alias("found"), F.max("low").alias("low"), F.max("high").alias("high")
    )
    keys, first = spec.table_keys, col(spec.table_keys[0])
    picked = batch.where(has_full_key(keys)).select(*[col(k) for k in keys]).distinct()
    ends = picked.agg(F.min(first).alias("least"), F.max(first).alias("most"))
    # one row per partition, and the batch's bounds: none of them grows with the rows
    known = {r[PARTITION]: r for r in heads.collect()}
    span = ends.first()
    sure = {p for p, r in known.items() if p in there and r["slots"] == r["found"] and r["stamp"] == _stamp(table, partition_path(table.path, p, folder))}
    may = there - sure
    if span["least"] is None:
        return sorted(may)
    near = {p for p in sure if known[p]["low"] is not None and known[p]["low"] <= span["most"] and known[p]["high"] >= span["least"]}
    may |= {p for p in near if not known[p]["slots"]}
    asked = sorted(near - may)
    if asked:
        key = F.xxhash64(F.lit("key"), *[col(k) for k in keys]).alias("key")
        bits = picked.select(key, F.explode(_positions(keys)).alias("at"))
        bits = bits.select("key", F.bitmap_bucket_number("at").alias("slot"), F.bitmap_bit_position("at").alias("place"))
        byte = F.conv(F.hex(F.substring("bits", F.shiftright("place", 3).cast("int") + 1, 1)), 16, 10).cast("long")
        hit = F.getbit(byte, (F.col("place") % 8).cast("int")) == 1
        met = entries.where(col(PARTITION).isin(asked)).join(bits, "slot").where(hit)
        met = met.groupBy(PARTITION, "key").count().where(F.col("count") == HASHES)
        may |= {r[0] for r in met.select(PARTITION).distinct().collect()}
    return sorted(may)


def read_candidates(
    spark: SparkSession, spec: TableSpec, path: str, batch: DataFrame, rows: int | None = None
) -> DataFrame:
    """The stored table, without partitions that surely hold no open version of the batch's
    keys. It classifies the batch as the whole table does."""
    found = partitions_with_keys(spark, spec, path, batch, rows)
    return read_final(spark, spec, path) if found is None else read_partitions(spark, spec, path, found)
