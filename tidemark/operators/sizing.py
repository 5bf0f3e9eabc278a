"""Size checks that stand before the broadcasts in this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import col

ROW_BYTES = 32  # of a row in a broadcast table, besides its values


def _threshold(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """True when Catalyst's size estimate of ``df`` is within the session's
    ``spark.sql.autoBroadcastJoinThreshold``.

    Staged tables and landed files are estimated from their file sizes. A plan
    whose size Catalyst cannot bound (a join, a frame built from an RDD) is
    estimated high, so it takes the shuffle way. A threshold of -1 turns all
    broadcasts off.
    """
    return estimated_bytes(df) <= _threshold(df)


def _plain_scan(df: DataFrame) -> bool:
    """Rows as they are stored, picked, filtered or made distinct: cheap to read twice."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter", "Aggregate"):
        node = node.children().apply(0)
    return node.children().isEmpty()


def _width(df: DataFrame) -> int:
    return ROW_BYTES + df._jdf.schema().defaultSize()


def fits_by_rows(df: DataFrame, rows: int | None = None) -> bool:
    """`fits_broadcast`, and so many rows as it has fit too. Files can be far smaller
    than their rows. Where the caller knows how many ``rows`` there are at most, say
    from a count that was observed while they were written, that settles it; else they
    are counted, only where the files are small, and only stored rows, since others
    would be worked out twice."""
    if not fits_broadcast(df):
        return False
    if rows is not None:
        return rows * _width(df) <= _threshold(df)
    return _plain_scan(df) and df.count() * _width(df) <= _threshold(df)


def few_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame | None:
    """The ``keys`` of ``df`` to be broadcast for a semi or anti join, or None where they
    are many. Rows of few keys but in great number are made distinct first. ``rows``: as
    many as ``df`` has at most, if that is known."""
    picked = df.select(*[col(k) for k in keys])
    if fits_by_rows(picked, rows):
        return F.broadcast(picked)
    distinct = picked.distinct()
    return F.broadcast(distinct) if fits_by_rows(distinct) else None
