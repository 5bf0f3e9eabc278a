"""Column functions: row hash, audit columns, closing of versions."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CURRENT = "current"
EFFECTIVE = "effectiveDate"
END = "endDate"
HASH = "rowHash"
PARTITION = "partitionKey"
AUDIT_COLUMNS = (CURRENT, EFFECTIVE, END, HASH)

OPEN_FLAG = "Y"
CLOSED_FLAG = "N"


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_run_date(value: date | str) -> date:
    """A calendar day from a date, a timestamp or ISO text."""
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def as_date(run_date: date | str) -> Column:
    """The run date as a foldable DATE literal."""
    return F.lit(parse_run_date(run_date))


def row_hash(columns: Sequence[str], mode: str = "delimited") -> Column:
    """SHA-256 (hex) over the text of ``columns``, in order.

    ``delimited`` writes each value as ``<length>:<text>`` and NULL as ``-``, so
    neither shifted text (``ab|c`` and ``a|bc``) nor NULL and ``''`` collide.
    ``compat`` is the plain concatenation with NULL as ``''``, for tables whose
    stored hashes were made that way.
    """
    texts = [col(c).cast("string") for c in columns]
    if mode == "delimited":
        parts = [
            F.when(t.isNull(), F.lit("-")).otherwise(
                F.concat(F.length(t).cast("string"), F.lit(":"), t)
            )
            for t in texts
        ]
    elif mode == "compat":
        parts = [F.coalesce(t, F.lit("")) for t in texts]
    else:
        raise ValueError(f"unknown hash mode {mode!r}: use 'delimited' or 'compat'")
    return F.sha2(F.concat(*parts), 256)


def list_name(columns: Sequence[str], mode: str) -> str:
    """A short name for what a row hash is made of: its columns, in order, and its mode."""
    return hashlib.sha256(json.dumps([mode, *columns]).encode()).hexdigest()[:8]


def named_hash(columns: Sequence[str], mode: str, name: str) -> Column:
    """The row hash behind the name of its column list, ``<name>:<hash>``; bare where the
    name is ''."""
    bare = row_hash(columns, mode)
    return F.concat(F.lit(f"{name}:"), bare) if name else bare


def with_audit(
    df: DataFrame,
    columns: Sequence[str],
    run_date: date | str,
    partition_key: int | None = None,
    hash_mode: str = "delimited",
    hash_name: str = "",
) -> DataFrame:
    """``columns`` of ``df`` plus the audit columns of an open version.

    The run date and the partition key are literals of the run, so a re-run of
    the same batch gives the same rows. ``hash_name`` goes before the hash, as in
    `named_hash`.
    """
    audit = [
        F.lit(OPEN_FLAG).alias(CURRENT),
        as_date(run_date).alias(EFFECTIVE),
        F.lit(None).cast("date").alias(END),
        named_hash(columns, hash_mode, hash_name).alias(HASH),
    ]
    if partition_key is not None:
        audit.append(F.lit(int(partition_key)).cast("int").alias(PARTITION))
    return df.select(*[col(c) for c in columns], *audit)


def close_rows(df: DataFrame, run_date: date | str, when: Column | None = None) -> DataFrame:
    """Close the versions for which ``when`` holds (all of them by default).

    A version ends the day before the run, yet never before it began: a second
    change on one day closes the first version on that very day.
    """
    last_day = F.greatest(col(EFFECTIVE), F.date_sub(as_date(run_date), 1))
    flag = F.lit(CLOSED_FLAG)
    if when is not None:
        flag = F.when(when, flag).otherwise(col(CURRENT))
        last_day = F.when(when, last_day).otherwise(col(END))
    return df.withColumns({CURRENT: flag, END: last_day})
