"""Columns that come and go do not change every row."""

import pytest

from tests.helpers import day, tuples
from tidemark import TableSpec, load_batch
from tidemark.sources import read_final

RAW = "k int, v string, w string, x int"


def made(*columns, scd_type=2, **options):
    return TableSpec("dim", ("k",), RAW, scd_type, columns=columns, versioned_hash=True, **options)


def rows(spark, *values):
    return spark.createDataFrame(values, RAW)


@pytest.mark.parametrize("options", [{}, {"partitioned": True, "key_index": True}, {"table_format": "orc"}, {"buckets": 2}, {"snapshots": 2}])
def test_added_and_removed(spark, tmp_path, options):
    path, old, wide, narrow = str(tmp_path / "dim"), made("k", "v", **options), made("k", "v", "w", **options), made("k", "w", "x", **options)

    def load(s, n, *values):
        got = load_batch(spark, s, rows(spark, *values), path, day(n), 100 + n)
        return got.new, got.changed

    assert load(old, 1, (1, "a", "p", 1), (2, "b", "p", 1), (3, None, "p", 1)) == (3, 0)
    # w is new: by v alone nothing has changed but key 2
    assert load(wide, 2, (1, "a", "q", 1), (2, "c", "q", 1), (3, None, None, 1)) == (0, 1)
    # a row stored without w has none until it changes; one stored with it is compared by it
    assert load(wide, 3, (1, "a", "z", 1), (2, "c", "z", 1), (4, "d", "z", 1)) == (1, 1)
    # v goes, x comes: rows of the first list have nothing left but their keys
    assert load(narrow, 4, (1, "?", "y", 7), (2, "?", "z", 7), (4, "?", "y", 7)) == (0, 1)
    # and back again, in another order
    assert load(made("w", "v", "k", **options), 5, (1, "a", "z", 0), (2, "c", "z", 0), (4, "d", "y", 0), (3, "n", "z", 0)) == (0, 1)
    table = read_final(spark, made("k", "v", "w", "x", **options), path)
    assert tuples(table.where("current = 'Y'"), "k", "w") == [(1, None), (2, "z"), (3, "z"), (4, "y")]
    assert table.count() == 8 and table.selectExpr("count(DISTINCT split(rowHash, ':')[0])").first()[0] >= 3


def test_a_table_from_before(spark, tmp_path):
    path = str(tmp_path / "dim")
    plain = TableSpec("dim", ("k",), RAW, 1, columns=("k", "v"), hash_mode="compat")
    load_batch(spark, plain, rows(spark, (1, "a", "p", 1), (2, "b", "p", 1)), path, day(1))
    # named hashes begin, in another mode: what is stored counts as it was
    got = load_batch(spark, made("k", "v", scd_type=1, hash_mode="compat"), rows(spark, (1, "a", "p", 1), (2, "c", "p", 1)), path, day(2))
    assert (got.new, got.changed) == (0, 1)
    got = load_batch(spark, made("k", "v", "w", scd_type=1), rows(spark, (1, "a", "p", 1), (2, "c", "p", 1)), path, day(3))
    assert (got.new, got.changed) == (0, 0)
    got = load_batch(spark, made("k", "x", scd_type=1), rows(spark, (1, "a", "p", 1), (2, "c", "p", 1), (3, "c", "p", 1)), path, day(4))
    assert (got.new, got.changed) == (1, 0)


def test_renamed_and_cast_columns(spark, tmp_path):
    path = str(tmp_path / "dim")
    wide = made("k", "v", "x", stored_schema="id bigint, name string, amount decimal(8,2)")
    narrow = made("k", "x", stored_schema="id bigint, amount decimal(8,2)")
    load_batch(spark, wide, rows(spark, (1, "a", "p", 1), (2, "b", "p", 2)), path, day(1))
    got = load_batch(spark, narrow, rows(spark, (1, "z", "p", 1), (2, "z", "p", 3)), path, day(2))
    assert (got.new, got.changed) == (0, 1)
    got = load_batch(spark, wide, rows(spark, (1, "a", "p", 1), (2, "b", "p", 3)), path, day(3))
    assert (got.new, got.changed) == (0, 0)


def test_several_and_missing_hashes(spark, tmp_path):
    path, s = str(tmp_path / "dim"), made("k", "v", on_duplicate_keys="keep", null_key_policy="keep")
    load_batch(spark, s, rows(spark, (1, "a", "p", 1), (1, "b", "p", 1), (None, "a", "p", 1)), path, day(1))
    got = load_batch(spark, made("k", "v", "w"), rows(spark, (1, "a", "p", 1)), path, day(2))
    assert (got.new, got.changed) == (0, 1)  # open versions that differ are never unchanged
    assert tuples(read_final(spark, made("k", "v"), path).where("current = 'Y'"), "k", "v") == [(1, "a"), (None, "a")]


def test_what_named_hashes_do_not_go_with(spark):
    for options in ({"table_format": "csv"}, {"scd_type": 0}, {"close_scope": "all"}):
        with pytest.raises(ValueError, match="versioned_hash"):
            made("k", "v", **options)
