"""Small frames and a plain-Python model of the loads."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark import TableSpec
from tidemark.functions import row_hash

SCHEMA = "k int, v string"
STORED = "k int, v string, current string, effectiveDate date, endDate date, rowHash string"


def spec(scd_type=2, **options):
    return TableSpec("dim", ("k",), SCHEMA, scd_type, **options)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def stored(spark, rows, partitioned=False):
    """Rows (k, v, current, effective day, end day[, partition]); hash of (k, v)."""
    schema = STORED.replace(", rowHash string", ", partitionKey int" if partitioned else "")
    rows = [
        (r[0], r[1], r[2], day(r[3]), None if r[4] is None else day(r[4]), *r[5:]) for r in rows
    ]
    return spark.createDataFrame(rows, schema).withColumn("rowHash", row_hash(["k", "v"]))


def batch(spark, rows, run_day=10, partition=None):
    df = frame(spark, rows).withColumns(
        {
            "current": F.lit("Y"),
            "effectiveDate": F.lit(day(run_day)),
            "endDate": F.lit(None).cast("date"),
            "rowHash": row_hash(["k", "v"]),
        }
    )
    return df if partition is None else df.withColumn("partitionKey", F.lit(partition))


def tuples(df, *columns):
    chosen = columns or tuple(c for c in df.columns if c != "rowHash")
    rows = [tuple(r) for r in df.select(*chosen).collect()]
    return sorted(rows, key=repr)


@contextmanager
def conf(spark, **values):
    """Session settings for a block; underscores stand for dots."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def shuffle_joins(spark):
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        yield


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


class Model:
    """Type 1 and Type 2 over a dict and a list: what a load must come to."""

    def __init__(self, scd_type):
        self.scd_type = scd_type
        self.rows = []

    def load(self, rows, run_day, partition):
        for k, v in rows:
            is_open = [r for r in self.rows if r["k"] == k and r["current"] == "Y"]
            if is_open and all(r["v"] == v for r in is_open):
                continue
            for r in is_open:
                if self.scd_type == 1:
                    self.rows.remove(r)
                else:
                    r["current"] = "N"
                    r["end"] = max(r["start"], day(run_day - 1))
            self.rows.append(
                {"k": k, "v": v, "current": "Y", "start": day(run_day), "end": None, "p": partition}
            )

    def table(self, partitioned):
        columns = ["k", "v", "current", "start", "end"] + (["p"] if partitioned else [])
        return sorted((tuple(r[c] for c in columns) for r in self.rows), key=repr)
