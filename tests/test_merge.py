import pytest

from tests.helpers import batch, day, shuffle_joins, stored, tuples
from tidemark.operators import (
    classify_changes,
    retained_rows,
    scd1_merge,
    scd2_merge,
    superseded_rows,
)

TABLE = [
    (1, "a", "Y", 5, None),
    (1, "b", "N", 2, 4),
    (1, "a", "N", 0, 1),
    (2, "b", "Y", 0, None),
    (None, "n", "Y", 0, None),
]


def merge2(spark, table, rows, **options):
    classified = classify_changes(batch(spark, rows), table, ["k"], unique_keys=options.get("unique_keys", True))
    return tuples(scd2_merge(table, classified, ["k"], day(10), **options))


@pytest.fixture(params=["broadcast", "shuffle"])
def join_way(request, spark):
    if request.param == "shuffle":
        with shuffle_joins(spark):
            yield request.param
    else:
        yield request.param


@pytest.mark.parametrize("unique", [True, False])
def test_type2_closes_only_the_open_version(spark, join_way, unique):
    got = merge2(spark, stored(spark, TABLE), [(1, "c"), (2, "b"), (3, "n")], unique_keys=unique)
    assert got == sorted(
        [
            (1, "c", "Y", day(10), None),
            (1, "a", "N", day(5), day(9)),
            (1, "b", "N", day(2), day(4)),
            (1, "a", "N", day(0), day(1)),
            (2, "b", "Y", day(0), None),
            (3, "n", "Y", day(10), None),
            (None, "n", "Y", day(0), None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("unique", [True, False])
def test_reversion_keeps_all_history(spark, join_way, unique):
    table = stored(spark, [(1, "a", "N", 0, 4), (1, "b", "Y", 5, None)])
    assert merge2(spark, table, [(1, "a")], unique_keys=unique) == sorted(
        [
            (1, "a", "N", day(0), day(4)),
            (1, "b", "N", day(5), day(9)),
            (1, "a", "Y", day(10), None),
        ],
        key=repr,
    )


def test_close_scope_all_redates_history_and_loses_the_equal_version(spark, join_way):
    table = stored(spark, [(1, "a", "N", 0, 4), (1, "x", "N", 4, 4), (1, "b", "Y", 5, None)])
    assert merge2(spark, table, [(1, "a")], close_scope="all") == sorted(
        [
            (1, "x", "N", day(4), day(9)),
            (1, "b", "N", day(5), day(9)),
            (1, "a", "Y", day(10), None),
        ],
        key=repr,
    )


def test_second_change_on_one_day(spark, join_way):
    table = stored(spark, [(1, "a", "Y", 10, None)])
    assert merge2(spark, table, [(1, "b")]) == sorted(
        [(1, "a", "N", day(10), day(10)), (1, "b", "Y", day(10), None)], key=repr
    )


def test_several_open_versions_all_close(spark, join_way):
    table = stored(spark, [(1, "a", "Y", 0, None), (1, "b", "Y", 1, None)])
    for unique in (True, False):
        got = merge2(spark, table, [(1, "b")], unique_keys=unique)
        assert [r for r in got if r[2] == "Y"] == [(1, "b", "Y", day(10), None)]
        assert len(got) == 3


def test_duplicate_changed_keys_do_not_multiply_stored_rows(spark, join_way):
    table = stored(spark, TABLE)
    got = merge2(spark, table, [(1, "c"), (1, "d")], unique_keys=False)
    assert len(got) == len(TABLE) + 2
    everything = merge2(spark, table, [(1, "c"), (1, "d")], unique_keys=False, close_scope="all")
    assert len(everything) == len(TABLE) + 2


def test_type1_replaces(spark, join_way):
    table = stored(spark, [r for r in TABLE if r[2] == "Y"])
    classified = classify_changes(batch(spark, [(1, "c"), (2, "b"), (3, "n")]), table, ["k"])
    assert tuples(scd1_merge(table, classified, ["k"])) == sorted(
        [
            (1, "c", "Y", day(10), None),
            (2, "b", "Y", day(0), None),
            (3, "n", "Y", day(10), None),
            (None, "n", "Y", day(0), None),
        ],
        key=repr,
    )


def test_retained_and_superseded_make_up_the_open_table(spark, join_way):
    table = stored(spark, TABLE)
    classified = classify_changes(batch(spark, [(1, "c"), (3, "n")]), table, ["k"])
    assert tuples(retained_rows(table, classified, ["k"]), "k", "v") == [(2, "b"), (None, "n")]
    assert tuples(superseded_rows(table, classified, ["k"], day(10)), "k", "v", "current", "endDate") == [
        (1, "a", "N", day(9))
    ]


def test_empty_batch_changes_nothing(spark, join_way):
    table = stored(spark, TABLE)
    assert merge2(spark, table, []) == tuples(table)


def test_unknown_close_scope(spark):
    with pytest.raises(ValueError, match="close_scope"):
        merge2(spark, stored(spark, TABLE), [(1, "c")], close_scope="none")
