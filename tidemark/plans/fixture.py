"""A stored dimension and a batch against it, derived from a base table.

Of the base rows, by key modulo: 9 of 10 are stored as open versions in three
partitions, some with a closed earlier version; the batch holds changed, new and
unchanged rows, and a third of its changes revert to the closed version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import CURRENT, EFFECTIVE, END, HASH, PARTITION, col, row_hash, with_audit
from tidemark.spec import TableSpec

RUN_DATE = "2024-02-01"
RUN_PARTITION = 20240201
HISTORY_PARTITION = 20230101
FIRST_PARTITION = 20240101

MONEY = "decimal(12,2)"


@dataclass(frozen=True)
class Source:
    """A base table, its key and the money column that changes."""

    table: str
    key: str
    amount: str
    columns: Sequence[tuple[str, str]]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {ddl}" for name, ddl in self.columns)


CUSTOMER = Source(
    "customer",
    "c_custkey",
    "c_acctbal",
    (
        ("c_custkey", "bigint"),
        ("c_name", "string"),
        ("c_nationkey", "int"),
        ("c_acctbal", MONEY),
        ("c_mktsegment", "string"),
    ),
)
ORDERS = Source(
    "orders",
    "o_orderkey",
    "o_totalprice",
    (
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", MONEY),
        ("o_orderdate", "date"),
        ("o_orderpriority", "string"),
    ),
)


def spec_of(source: Source, scd_type: int = 2, **options) -> TableSpec:
    options = {"hash_mode": "compat", "raw_schema": source.ddl} | options
    return TableSpec(name=source.table, keys=(source.key,), scd_type=scd_type, **options)


def base(spark: SparkSession, sf_dir: str, source: Source = CUSTOMER) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{source.table}.parquet")
    return rows.select(*[col(name).cast(ddl).alias(name) for name, ddl in source.columns])


def stored_table(
    spark: SparkSession,
    sf_dir: str,
    source: Source = CUSTOMER,
    hash_mode: str = "compat",
    whole: bool = False,
) -> DataFrame:
    """Open versions in three partitions, and closed earlier ones. The keys that the
    batch shall bring as new ones are left out, unless all are to be stored."""
    key = col(source.key)
    kept = base(spark, sf_dir, source)
    kept = kept if whole else kept.where(key % 10 != 9)
    open_rows = kept.withColumns(
        {
            CURRENT: F.lit("Y"),
            EFFECTIVE: F.lit("2024-01-01").cast("date"),
            END: F.lit(None).cast("date"),
            PARTITION: (F.lit(FIRST_PARTITION) + key % 3).cast("int"),
        }
    )
    earlier = F.when(key % 12 == 0, col(source.amount) + 100).otherwise(col(source.amount) - 50)
    closed_rows = kept.where((key % 12).isin(0, 4)).withColumns(
        {
            source.amount: earlier.cast(MONEY),
            CURRENT: F.lit("N"),
            EFFECTIVE: F.lit("2023-01-01").cast("date"),
            END: F.lit("2023-12-31").cast("date"),
            PARTITION: F.lit(HISTORY_PARTITION),
        }
    )
    both = open_rows.unionByName(closed_rows).withColumn(HASH, row_hash(source.names, hash_mode))
    return both.select(*source.names, CURRENT, EFFECTIVE, END, HASH, PARTITION)


def landed_batch(spark: SparkSession, sf_dir: str, source: Source = CUSTOMER) -> DataFrame:
    """Business columns of the batch: changed (key % 4 = 0), unchanged, and new ones."""
    key = col(source.key)
    rows = base(spark, sf_dir, source).where((key % 2 == 0) | (key % 10 == 9))
    amount = F.when(key % 4 == 0, col(source.amount) + 100).otherwise(col(source.amount))
    return rows.withColumn(source.amount, amount.cast(MONEY)).select(*source.names)


def audited_batch(
    spark: SparkSession, sf_dir: str, source: Source = CUSTOMER, hash_mode: str = "compat"
) -> DataFrame:
    batch = landed_batch(spark, sf_dir, source)
    return with_audit(batch, source.names, RUN_DATE, RUN_PARTITION, hash_mode)
