import hashlib
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import day, frame, stored, tuples
from tidemark.functions import close_rows, row_hash, with_audit


def hashes(spark, rows, mode):
    df = frame(spark, rows, "a string, b string").select(row_hash(["a", "b"], mode).alias("h"))
    return [r.h for r in df.collect()]


def test_compat_hash_is_sha256_of_plain_concatenation(spark):
    got = hashes(spark, [("ab", "c"), (None, "é")], "compat")
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in ("abc", "é")]


@pytest.mark.parametrize("pair", [[("ab", "c"), ("a", "bc")], [(None, "x"), ("", "x")], [("-", "x"), (None, "x")]])
def test_delimited_hash_tells_apart_what_compat_does_not(spark, pair):
    assert len(set(hashes(spark, pair, "delimited"))) == 2


@pytest.mark.parametrize("pair", [[("ab", "c"), ("a", "bc")], [(None, "x"), ("", "x")]])
def test_compat_hash_collides_on_shifted_text_and_null(spark, pair):
    assert len(set(hashes(spark, pair, "compat"))) == 1


def test_values_that_look_like_the_delimiter_do_not_collide(spark):
    pair = [("1:a1:b", ""), ("1:a", "1:b"), ("a1:b0:", None), ("a", "1:b0:")]
    assert len(set(hashes(spark, pair, "delimited"))) == 4


def test_delimited_hash_is_one_to_one_on_awkward_text(spark):
    rnd = random.Random(7)
    texts = [None, *("".join(rnd.choices("01:-a", k=rnd.randint(0, 4))) for _ in range(300))]
    rows = sorted({(rnd.choice(texts), rnd.choice(texts)) for _ in range(5000)}, key=repr)
    assert len(set(hashes(spark, rows, "delimited"))) == len(rows)


def test_unknown_hash_mode(spark):
    with pytest.raises(ValueError, match="hash mode"):
        row_hash(["a"], "md5")


def test_audit_columns(spark):
    df = with_audit(frame(spark, [(1, "a")]), ["v", "k"], "2024-02-01", 20240201)
    assert dict(df.dtypes) == {
        "v": "string",
        "k": "int",
        "current": "string",
        "effectiveDate": "date",
        "endDate": "date",
        "rowHash": "string",
        "partitionKey": "int",
    }
    assert tuples(df) == [("a", 1, "Y", date(2024, 2, 1), None, 20240201)]
    assert "partitionKey" not in with_audit(frame(spark, [(1, "a")]), ["k", "v"], day(0)).columns


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "a")], ["current balance", "x.y`z"])
    got = with_audit(df, df.columns, "2024-02-01").first()
    assert got["x.y`z"] == "a" and got["current"] == "Y"


def test_close_ends_the_day_before_but_never_before_the_start(spark):
    table = stored(spark, [(1, "a", "Y", 3, None), (2, "b", "Y", 10, None)])
    got = tuples(close_rows(table, day(10)), "k", "current", "endDate")
    assert got == [(1, "N", day(9)), (2, "N", day(10))]


def test_close_some(spark):
    table = stored(spark, [(1, "a", "Y", 3, None), (2, "b", "N", 1, 2)])
    got = tuples(close_rows(table, day(10), F.col("k") == 1), "k", "current", "endDate")
    assert got == [(1, "N", day(9)), (2, "N", day(2))]
