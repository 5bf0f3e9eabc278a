"""Tables whose files are cut into buckets by merge key.

Files of a bucket carry its number in their names, as Spark's bucketed tables have it, and
lie in the table's folder like any others: whatever reads that folder reads the table. A
note in the folder names keys and number. Spark takes a bucketing from its catalog alone,
so a table of a name of its own is made there for each scan and each write, and dropped at
once; its files stay.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.functions import CURRENT, PARTITION, col
from tidemark.sources.filesystem import Directory
from tidemark.sources.formats import spark_format, table_options, writable
from tidemark.spec import TableSpec

NOTE = "_buckets"
# partitions are listed from their folders, not kept in the catalog
TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def bucket_count(spark: SparkSession, spec: TableSpec, path: str) -> int | None:
    """How many buckets the table at ``path`` has: what its note says, None without one,
    and what the spec asks where there is no table yet (or an empty folder)."""
    table = Directory(spark, path)
    note = f"{table.path}/{NOTE}"
    if table.exists(note):
        found = json.loads(table.read(note))
        if found["keys"] != list(spec.table_keys):
            raise ValueError(f"{path} is bucketed by {found['keys']}, not by {list(spec.table_keys)}")
        return found["buckets"]
    if spec.buckets is None or table.names("[^_.]*", most=0)[0]:
        return None
    return spec.buckets


def note_buckets(spark: SparkSession, spec: TableSpec, path: str, buckets: int) -> None:
    folder = Directory(spark, path)
    note = f"{folder.path}/{NOTE}"
    if not folder.exists(note):
        folder.write(note, json.dumps({"keys": list(spec.table_keys), "buckets": buckets}))


def by_bucket(df: DataFrame, spec: TableSpec, buckets: int | None) -> DataFrame:
    """``df`` shuffled as the table's buckets are, so that a join with them shuffles
    nothing more, and each bucket is written by one task."""
    return df if buckets is None else df.repartition(buckets, *[col(k) for k in spec.table_keys])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def _catalog_name(spark: SparkSession) -> Iterator[str]:
    name = f"tidemark_{uuid4().hex}"
    tracked = spark.conf.get(TRACKED, None)
    spark.conf.set(TRACKED, "false")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.conf.unset(TRACKED) if tracked is None else spark.conf.set(TRACKED, tracked)


def bucketed_scan(spark: SparkSession, spec: TableSpec, path: str, schema: StructType, buckets: int) -> DataFrame:
    """The files at ``path`` under ``schema``, known to Spark as bucketed by key."""
    fields = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(_quoted(k) for k in spec.table_keys)
    parts = f"PARTITIONED BY ({_quoted(schema[-1].name)})" if spec.partitioned else ""
    location = Directory(spark, path).path.replace("\\", "\\\\").replace("'", "\\'")
    with _catalog_name(spark) as name:
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING {spark_format(spec.table_format)} {parts} "
            f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        return spark.table(name)


def write_bucketed(df: DataFrame, spec: TableSpec, path: str, buckets: int, folder: str | None) -> None:
    """Writes ``df`` to the folder ``path`` in buckets; of a Type 2 table each file is
    sorted by flag. ``folder``: how partitions are named."""
    if folder is not None:
        df = df.withColumnRenamed(PARTITION, folder)
    writer = writable(df, spec).write.format(spark_format(spec.table_format)).options(**table_options(spec))
    writer = writer.mode("overwrite").bucketBy(buckets, *spec.table_keys)
    if spec.scd_type == 2:
        writer = writer.sortBy(CURRENT)
    if folder is not None:
        writer = writer.partitionBy(folder)
    with _catalog_name(df.sparkSession) as name:
        writer.option("path", path).saveAsTable(name)
