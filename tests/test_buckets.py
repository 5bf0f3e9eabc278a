"""Tables bucketed by merge key: layout, plans, and that results are those of plain ones."""

import random
from pathlib import Path

import pytest

from tests.helpers import SCHEMA, Model, day, frame, plan_of, shuffle_joins, spec, stored, tuples
from tidemark import TableSpec, load_batch
from tidemark.functions import with_audit
from tidemark.operators import classify_changes, scd1_parts, scd2_parts
from tidemark.sources import read_final, replace_table
from tidemark.sources.buckets import bucket_count, by_bucket

ROWS = [(k, "a", "Y", 5, None, 10 + k % 2) for k in range(40)] + [(k, "b", "N", 0, 4, 9) for k in range(40)]


def bucketed(scd_type=2, **options):
    return spec(scd_type, buckets=4, **options)


def build(spark, s, path, rows=ROWS):
    replace_table(stored(spark, rows, partitioned=True).select(*s.final_struct.names), s, str(path))
    return read_final(spark, s, str(path))


@pytest.mark.parametrize("partitioned", [False, True])
def test_files_lie_in_the_folder_by_bucket(spark, tmp_path, partitioned):
    s = bucketed(partitioned=partitioned)
    table = build(spark, s, tmp_path / "dim")
    files = list((tmp_path / "dim").rglob("*.parquet"))
    assert len(files) == (12 if partitioned else 4)
    assert {f.name.rsplit("_", 1)[1][:5] for f in files} == {f"0000{b}" for b in range(4)}
    plain = read_final(spark, spec(2, partitioned=partitioned), str(tmp_path / "dim"))
    assert tuples(table) == tuples(plain) == tuples(spark.read.schema(table.schema).parquet(str(tmp_path / "dim")))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]
    assert not list(Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")).glob("tidemark_*"))


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_classification_exchanges_the_batch_alone(spark, tmp_path):
    s = bucketed(partitioned=True)
    table = build(spark, s, tmp_path / "dim")
    rows = by_bucket(with_audit(frame(spark, [(k, "z") for k in range(30)]), ("k", "v"), day(9), 12), s, 4)
    with shuffle_joins(spark):
        classified = classify_changes(rows, table, ["k"])
        assert exchanges(classified) == 1
        assert "SelectedBucketsCount: 4 out of 4" in plan_of(classified)
        assert classified.count() == 30


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_merge_does_not_exchange_the_stored_side(spark, tmp_path, scd_type):
    s = bucketed(scd_type)
    rows = [r for r in ROWS if scd_type == 2 or r[2] == "Y"]
    table = build(spark, s, tmp_path / "dim", rows)
    new = with_audit(frame(spark, [(k, "z") for k in range(30)]), ("k", "v"), day(9))
    classify_changes(new, table, ["k"]).write.parquet(str(tmp_path / "classified"))
    changes = by_bucket(spark.read.parquet(str(tmp_path / "classified")), s, 4)
    with shuffle_joins(spark):
        parts = scd1_parts(table, changes, ["k"]) if scd_type == 1 else scd2_parts(table, changes, ["k"], day(9))
        plan = plan_of(parts.moved)
        # the changed keys and the rows that come in, both of the batch
        assert exchanges(parts.moved) <= 2 and "SortMergeJoin" in plan
        assert "Bucketed: true" in plan
        assert "Exchange" not in plan_of(parts.in_place)


@pytest.mark.parametrize(
    ("scd_type", "partitioned", "shuffled"), [(1, False, False), (1, True, True), (2, False, True), (2, True, False), (2, True, True)]
)
def test_loads_come_to_the_model(spark, tmp_path, scd_type, partitioned, shuffled):
    random.seed(f"{scd_type}{partitioned}{shuffled}")
    s, model, path = bucketed(scd_type, partitioned=partitioned), Model(scd_type), str(tmp_path / "dim")

    def loads():
        for n in range(4):
            rows = [(k, random.choice("ab")) for k in random.sample(range(30), 20)]
            load_batch(spark, s, frame(spark, rows), path, day(10 * n), 100 + n)
            model.load(rows, 10 * n, 100 + n)
            assert tuples(read_final(spark, s, path)) == model.table(partitioned)
            assert bucket_count(spark, s, path) == 4

    if shuffled:
        with shuffle_joins(spark):
            loads()
    else:
        loads()


def test_a_table_keeps_its_layout(spark, tmp_path):
    plain, s = spec(2, partitioned=True), bucketed(partitioned=True)
    before, after = str(tmp_path / "plain"), str(tmp_path / "bucketed")
    build(spark, plain, before)
    build(spark, s, after)
    for path, its, other in ((before, None, s), (after, 4, plain)):
        load_batch(spark, other, frame(spark, [(1, "z"), (99, "n")]), path, day(20), 20)
        assert bucket_count(spark, s, path) == bucket_count(spark, plain, path) == its
    assert tuples(read_final(spark, plain, before)) == tuples(read_final(spark, s, after))
    # written anew as a whole, it takes the layout asked for
    replace_table(read_final(spark, s, before), s, before)
    replace_table(read_final(spark, plain, after), plain, after)
    assert (bucket_count(spark, s, before), bucket_count(spark, plain, after)) == (4, None)
    assert tuples(read_final(spark, s, before)) == tuples(read_final(spark, plain, after))


def test_a_first_load_cut_off_before_its_note_is_repeated(spark, tmp_path):
    s, path = bucketed(partitioned=True), tmp_path / "dim"
    path.mkdir()
    (path / "_buckets_unfinished").write_text("{")
    load_batch(spark, s, frame(spark, [(1, "a"), (2, "b")]), str(path), day(1), 5)
    assert bucket_count(spark, s, str(path)) == 4
    assert len(tuples(read_final(spark, s, str(path)))) == 2


def test_an_empty_table_and_odd_names(spark, tmp_path):
    s = bucketed(partitioned=True)
    table = build(spark, s, tmp_path / "it's 1", [])
    assert table.count() == 0 and table.columns == s.final_struct.names
    load_batch(spark, s, frame(spark, [(1, "a")]), str(tmp_path / "it's 1"), day(1), 5)
    assert tuples(read_final(spark, s, str(tmp_path / "it's 1")))[0][:2] == (1, "a")


def test_session_settings_are_as_before(spark, tmp_path):
    name = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(name)
    build(spark, bucketed(partitioned=True), tmp_path / "dim")
    assert spark.conf.get(name) == before


def test_what_buckets_do_not_go_with(spark, tmp_path):
    for options in (
        {"on_duplicate_keys": "keep"},
        {"null_key_policy": "keep"},
        {"table_format": "csv"},
        {"files_per_partition": 2},
        {"scd_type": 0},
    ):
        with pytest.raises(ValueError, match="bucket"):
            bucketed(**options)
    with pytest.raises(ValueError, match="at least 1"):
        spec(2, buckets=0)
    path = str(tmp_path / "dim")
    build(spark, bucketed(), path)
    with pytest.raises(ValueError, match="bucketed by key"):
        load_batch(spark, spec(2, on_duplicate_keys="keep"), frame(spark, [(1, "a")]), path, day(30))
    with pytest.raises(ValueError, match="not by"):
        read_final(spark, TableSpec("dim", ("v",), SCHEMA, 2, buckets=4), path)
