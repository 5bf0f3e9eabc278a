"""Shapes of the physical plans that the loads rely on."""

import pytest

from pyspark.sql import functions as F

from tests.helpers import batch, frame, plan_of, shuffle_joins, spec, stored
from tidemark.functions import row_hash
from tidemark.operators import (
    classify_changes,
    dedupe_batch,
    fits_broadcast,
    new_rows,
    retained_rows,
    scd1_parts,
    scd2_parts,
)
from tidemark.operators import changes
from tidemark.sources import read_final, replace_table

TABLE = [(k, "a", "Y", 5, None, 10) for k in range(20)] + [(k, "b", "N", 0, 4, 9) for k in range(20)]


@pytest.fixture
def files(spark, tmp_path):
    """A stored table and a classified batch, as files whose size Catalyst knows."""
    s = spec(2, partitioned=True)
    path = str(tmp_path / "dim")
    replace_table(stored(spark, TABLE, partitioned=True).select(*s.final_struct.names), s, path)
    table = read_final(spark, s, path)
    rows = batch(spark, [(1, "z"), (50, "n")], partition=11)
    classify_changes(rows, table, ["k"]).write.parquet(str(tmp_path / "classified"))
    rows.write.parquet(str(tmp_path / "batch"))
    return (
        table,
        spark.read.parquet(str(tmp_path / "classified")),
        spark.read.parquet(str(tmp_path / "batch")),
    )


def test_few_changes_leave_the_stored_rows_unshuffled(files):
    table, classified, _ = files
    parts = scd2_parts(table, classified, ["k"], "2024-02-01", unique_keys=True)
    table_side, keys_side = plan_of(parts.in_place).split("BroadcastExchange")
    assert "BroadcastHashJoin" in table_side and "hashpartitioning" not in table_side
    assert table_side.count("FileScan") == keys_side.count("FileScan") == 1
    one = scd1_parts(table, classified, ["k"])
    assert "LeftAnti" in plan_of(one.in_place) and "hashpartitioning" not in plan_of(one.in_place)


@pytest.mark.parametrize("unique", [True, False])
def test_many_changes_shuffle_open_versions_only(spark, files, unique):
    table, classified, _ = files
    with shuffle_joins(spark):
        parts = scd2_parts(table, classified, ["k"], "2024-02-01", unique_keys=unique)
        history, moved = plan_of(parts.in_place), plan_of(parts.moved)
    assert "Exchange" not in history and "Join" not in history
    assert "SortMergeJoin" in moved
    # a sketch has found no heavy key, so none is listed
    assert "Broadcast" not in moved and moved.count("Exchange hashpartitioning") <= 3
    pushed = [line for line in moved.splitlines() if "PushedFilters" in line]
    assert any("EqualTo(current,Y)" in line for line in pushed)


def test_classification_reads_few_columns_and_shuffles_each_side_once(spark, files):
    table, _, rows = files
    with shuffle_joins(spark):
        plan = plan_of(classify_changes(dedupe_batch(rows, ["k"]), table, ["k"]))
    assert plan.count("Exchange hashpartitioning") == 2
    scans = [line for line in plan.splitlines() if "FileScan" in line and "EqualTo(current,Y)" in line]
    assert len(scans) == 1
    assert "effectiveDate" not in scans[0] and "v:string" not in scans[0]
    assert "IsNotNull(k)" in scans[0]


def test_small_batch_cuts_the_table_before_its_shuffle(files, monkeypatch):
    table, _, rows = files
    # a small table is not worth counting the batch, unless it is counted already
    assert "LeftSemi" not in plan_of(classify_changes(rows, table, ["k"]))
    assert "LeftSemi" in plan_of(classify_changes(rows, table, ["k"], batch_rows=2))
    monkeypatch.setattr(changes, "SMALL_TABLE", 0)
    plan = plan_of(classify_changes(rows, table, ["k"]))
    assert "LeftSemi" in plan
    # the semi join comes below the aggregate that shuffles
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_anti_joins_are_anti_joins(files):
    table, classified, rows = files
    assert "LeftAnti" in plan_of(new_rows(rows, table, ["k"]))
    assert "LeftAnti" in plan_of(retained_rows(table, classified, ["k"]))


def test_frames_of_unknown_size_are_not_broadcast(spark, files):
    table, _, _ = files
    unknown = spark.createDataFrame(frame(spark, [(1, "z")]).rdd, "k int, v string")
    assert not fits_broadcast(unknown.select("k"))
    rows = unknown.withColumns({"rowHash": row_hash(["k", "v"]), "partitionKey": F.lit(11)})
    assert "LeftSemi" not in plan_of(classify_changes(rows, table, ["k"]))


def test_no_python_in_any_plan(files):
    table, classified, rows = files
    for df in (
        classify_changes(dedupe_batch(rows, ["k"]), table, ["k"]),
        scd2_parts(table, classified, ["k"], "2024-02-01").union(),
    ):
        assert "Python" not in plan_of(df) and "Pandas" not in plan_of(df)
