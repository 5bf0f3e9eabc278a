"""Every registered query against its SQL, on the driver's tables."""

import math
import os
import shutil
import subprocess
import sys
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.plans.queries import QUERIES as LOAD_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return str(value) if value is not None else None


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((v is not None, v or "") for v in t),
    )


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES)
    assert set(ORACLE_SQL) == set(LOAD_QUERIES)


@pytest.mark.parametrize("name", sorted(LOAD_QUERIES))
def test_matches_sql(spark, duck, name):
    expected = duck.execute(SQL[name])
    names = [d[0] for d in expected.description]
    want = rows_of(names, expected.fetchall())
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(names)
    got = rows_of(result.columns, result.collect())
    assert want and got == want


def test_entry_without_the_subpackage(tmp_path):
    here = Path(contract.__file__).parent
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__", ".git", "spark-warehouse")
    shutil.copytree(here, tmp_path / "repo", ignore=left_out)
    (tmp_path / "repo" / "tidemark" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), set(e.oracle_sql()) == set(e.ORACLE_SQL))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True)
    assert ran.stdout.split() == ["True", "True"]


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
