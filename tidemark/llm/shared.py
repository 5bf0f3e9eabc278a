"""Shared scratch tables: what an operator reads more than once is written where
the driver and all executors see it, so a lost executor costs no results."""

from __future__ import annotations

import os
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.filesystem import Directory


MAP_BITS = 1 << 26


def scratch(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, or under the warehouse where
    that is unset; removed when Spark ends."""
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = Directory(spark, f"{parent.rstrip('/')}/llm-{uuid4().hex}")
    folder.delete_on_exit()
    return folder.path


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to a scratch folder and read again."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parted(rows: DataFrame, hits: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` may be in ``hits``, and those whose key is surely not.

    The keys' hashes set bits of a map of 8 MB that is broadcast, however many keys there
    are; the more, the more rows pass for possible hits. So wide rows without a hit need
    not be shuffled for a join. NULL keys are surely no hits.
    """
    slot, place, bits = (f"{name}-{uuid4().hex}" for name in ("slot", "place", "bits"))
    number = F.pmod(F.xxhash64(key), F.lit(MAP_BITS)) + 1
    known = hits.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(number).alias(slot))
    known = known.agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(bits))
    marked = rows.withColumns({slot: F.bitmap_bucket_number(number), place: F.bitmap_bit_position(number)})
    marked = marked.join(F.broadcast(known), slot, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(place, 3).cast("int") + 1, 1)), 16, 10).cast("long")
    is_set = F.getbit(byte, (F.col(place) % 8).cast("int")) == 1
    maybe = F.coalesce(is_set & F.col(key).isNotNull(), F.lit(False))
    return tuple(marked.where(c).drop(slot, place, bits) for c in (maybe, ~maybe))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Has Spark bring this package to its Python workers, once per application, so that
    tasks find its functions wherever the library lies on the driver."""
    context, name = spark.sparkContext, "tidemark_package.zip"
    if name in getattr(context, "_python_includes", ()):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(SparkFiles.getRootDirectory(), f"ship-{os.getpid()}", name)
    archive.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
