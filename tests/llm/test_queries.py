"""Registered queries of the subpackage that SQL can express, on the driver's tables."""

import duckdb
import pytest

from tests.test_oracle import SF_DIR, rows_of
from tidemark.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    expected = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    want = rows_of(names, expected.fetchall())
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(names)
    assert rows_of(result.columns, result.collect()) == want
