import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import Model, conf, day, frame, shuffle_joins, spec, tuples
from tidemark import BaseDirs, TableSpec, load_batch, run_load
from tidemark.functions import PARTITION, with_audit
from tidemark.operators import skew
from tidemark.plans import queries
from tidemark.sources import read_final, replace_table, shared_folder
from tidemark.sources.tables import partition_path


def sequence(seed, runs=5, keys=8):
    """Batches with few keys and few values: changes, reversions, repeats, absences."""
    rnd = random.Random(seed)
    return [
        [(k, rnd.choice("abc")) for k in rnd.sample(range(keys), rnd.randint(1, keys))]
        for _ in range(runs)
    ]


def run_all(spark, s, path, batches):
    model = Model(s.scd_type)
    for n, rows in enumerate(batches):
        run_day, partition = 2 * n, 100 + n // 2 * 2
        before = len(model.rows)
        load_batch(spark, s, frame(spark, rows), path, day(run_day), partition)
        model.load(rows, run_day, partition)
        assert tuples(read_final(spark, s, path)) == model.table(s.partitioned)
        if s.scd_type == 2:
            assert len(model.rows) >= before
    return model


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("scd_type", [1, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_sequences_of_batches(spark, tmp_path, scd_type, partitioned, seed):
    """Runs 2n and 2n+1 share a partition, so partitions are added to as well."""
    s = spec(scd_type, partitioned=partitioned)
    run_all(spark, s, str(tmp_path / "dim"), sequence(seed))


@pytest.mark.parametrize("scd_type", [1, 2])
def test_sequences_with_shuffle_joins(spark, tmp_path, scd_type):
    with shuffle_joins(spark):
        for partitioned in (True, False):
            s = spec(scd_type, partitioned=partitioned)
            run_all(spark, s, str(tmp_path / f"dim{partitioned}"), sequence(3, runs=4))


@pytest.mark.parametrize("fmt", ["csv", "orc"])
def test_sequences_in_other_formats(spark, tmp_path, fmt):
    s = spec(2, partitioned=True, table_format=fmt, table_delimiter="|")
    run_all(spark, s, str(tmp_path / "dim"), sequence(4, runs=3))


def test_type1_is_the_open_view_of_type2(spark, tmp_path):
    one, two = spec(1), spec(2, partitioned=True)
    for n, rows in enumerate(sequence(5, runs=4)):
        for s, name in ((one, "one"), (two, "two")):
            load_batch(spark, s, frame(spark, rows), str(tmp_path / name), day(n), 100 + n)
    open_rows = read_final(spark, two, str(tmp_path / "two")).where("current = 'Y'")
    assert tuples(read_final(spark, one, str(tmp_path / "one")), "k", "v") == tuples(open_rows, "k", "v")


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("scd_type", [1, 2])
def test_loading_again_writes_nothing(spark, tmp_path, scd_type, partitioned):
    s, path = spec(scd_type, partitioned=partitioned), str(tmp_path / "dim")
    rows = frame(spark, [(k, "a") for k in range(6)])
    first = load_batch(spark, s, rows, path, day(1), 101)
    assert (first.new, first.changed) == (6, 0)
    files = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*")}
    again = load_batch(spark, s, rows, path, day(2), 102)
    assert (again.new, again.changed, again.affected) == (0, 0, ())
    assert files == {p: p.stat().st_mtime_ns for p in Path(path).rglob("*")}


def test_result_tells_what_was_done(spark, tmp_path):
    s, path = spec(1, partitioned=True), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1), 101)
    load_batch(spark, s, frame(spark, [(2, "a"), (3, "a")]), path, day(2), 102)
    got = load_batch(spark, s, frame(spark, [(1, "b"), (2, "b"), (9, "n")]), path, day(3), 103)
    assert (got.new, got.changed, got.affected, got.emptied) == (1, 2, (101, 102, 103), (101,))
    assert not Path(partition_path(path, 101)).exists()


def test_job_reads_landed_files_by_spec(spark, tmp_path):
    landing = tmp_path / "in" / "crm" / "dim"
    landing.mkdir(parents=True)
    s = spec(2, app_dir="crm", table_dir="dim", landing_pattern="dim_*.csv", landing_delimiter=";")
    dirs = BaseDirs(f"{tmp_path}/in/", f"{tmp_path}/out/")
    (landing / "dim_1.csv").write_text("k;v\n1;a\n2;b\n")
    (landing / "notes.csv").write_text("k;v\n7;x\n")
    assert run_load(spark, s, dirs, "2024-01-02").path == f"{tmp_path}/out/crm/dim"
    (landing / "dim_1.csv").write_text("k;v\n1;z\n")
    run_load(spark, s, dirs, "2024-01-05")
    got = tuples(read_final(spark, s, f"{tmp_path}/out/crm/dim"))
    assert got == sorted(
        [
            (1, "a", "N", day(1), day(3)),
            (1, "z", "Y", day(4), None),
            (2, "b", "Y", day(1), None),
        ],
        key=repr,
    )


def test_first_load_of_an_empty_batch(spark, tmp_path):
    s, path = spec(2), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, []), path, day(1))
    assert read_final(spark, s, path).count() == 0


def test_partition_key_is_needed_only_for_partitioned_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="partition key"):
        load_batch(spark, spec(2, partitioned=True), frame(spark, []), str(tmp_path / "a"), day(1))


def test_duplicates_kept_then_closed_together(spark, tmp_path):
    s, path = spec(2, on_duplicate_keys="keep", partitioned=True), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(5, "a"), (5, "b"), (5, "b"), (1, "x")]), path, day(1), 101)
    load_batch(spark, s, frame(spark, [(5, "c")]), path, day(2), 102)
    assert tuples(read_final(spark, s, path), "k", "v", "current") == sorted(
        [(5, "a", "N"), (5, "b", "N"), (5, "b", "N"), (5, "c", "Y"), (1, "x", "Y")], key=repr
    )


def test_last_duplicate_is_loaded(spark, tmp_path):
    s = spec(1, on_duplicate_keys="last", dedupe_by="v")
    load_batch(spark, s, frame(spark, [(5, "a"), (5, "b")]), str(tmp_path / "dim"), day(1))
    assert tuples(read_final(spark, s, str(tmp_path / "dim")), "k", "v") == [(5, "b")]


@pytest.mark.parametrize("way", ["broadcast", "shuffle"])
def test_null_keys_kept_pile_up_and_stay(spark, tmp_path, way):
    s, path = spec(2, null_key_policy="keep", partitioned=True), str(tmp_path / "dim")
    rows = frame(spark, [(None, "a"), (1, "a")])
    load_batch(spark, s, rows, path, day(1), 101)
    if way == "shuffle":
        with shuffle_joins(spark):
            load_batch(spark, s, frame(spark, [(None, "a"), (1, "b")]), path, day(2), 102)
    else:
        load_batch(spark, s, frame(spark, [(None, "a"), (1, "b")]), path, day(2), 102)
    assert tuples(read_final(spark, s, path), "k", "v", "current") == sorted(
        [(None, "a", "Y"), (None, "a", "Y"), (1, "a", "N"), (1, "b", "Y")], key=repr
    )


def test_a_null_key_fails_the_load_and_leaves_the_table(spark, tmp_path):
    s, path = spec(2), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1))
    with pytest.raises(PySparkException, match="NULL in merge key"):
        load_batch(spark, s, frame(spark, [(None, "a"), (1, "b")]), path, day(2))
    assert tuples(read_final(spark, s, path), "k", "v") == [(1, "a")]


def test_stale_copy_after_a_crash_is_cleared_by_the_next_change(spark, tmp_path):
    """A crash after the overwrite and before the clean-up leaves the moved row in
    its old partition too: two open versions of one key."""
    s, path = spec(1, partitioned=True), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1), 101)
    load_batch(spark, s, frame(spark, [(1, "b"), (2, "b")]), path, day(2), 102)
    again = with_audit(frame(spark, [(1, "a"), (3, "c")]), s.columns, day(1))
    again.write.mode("overwrite").parquet(partition_path(path, 101))
    assert tuples(read_final(spark, s, path), "k", PARTITION) == [(1, 101), (1, 102), (2, 102), (3, 101)]
    # the batch repeats the newer copy's value: it still differs from the stale one
    got = load_batch(spark, s, frame(spark, [(1, "b")]), path, day(3), 103)
    assert got.affected == (101, 102, 103)
    assert tuples(read_final(spark, s, path), "k", "v", PARTITION) == [
        (1, "b", 103),
        (2, "b", 102),
        (3, "c", 101),
    ]


@pytest.mark.parametrize("scd_type", [1, 2])
def test_open_versions_in_many_partitions_are_all_found(spark, tmp_path, scd_type):
    s, path = spec(scd_type, partitioned=True), str(tmp_path / "dim")
    for partition in (101, 102, 103, 104):
        rows = with_audit(frame(spark, [(1, f"v{partition}"), (partition, "x")]), s.columns, day(1))
        rows.write.parquet(partition_path(path, partition))
    got = load_batch(spark, s, frame(spark, [(1, "new")]), path, day(2), 110)
    assert got.affected == (101, 102, 103, 104, 110)
    rows = tuples(read_final(spark, s, path).where("k = 1"), "v", "current", PARTITION)
    closed = [] if scd_type == 1 else [(f"v{p}", "N", p) for p in (101, 102, 103, 104)]
    assert rows == sorted([*closed, ("new", "Y", 110)], key=repr)


def test_run_date_may_carry_a_time(spark, tmp_path):
    load_batch(spark, spec(2), frame(spark, [(1, "a")]), str(tmp_path / "d"), datetime(2024, 1, 2, 13))
    assert tuples(read_final(spark, spec(2), str(tmp_path / "d")), "effectiveDate") == [(day(1),)]


def test_work_folder_beside_the_table_when_the_session_names_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    settings = type(spark.conf)
    found = settings.get
    monkeypatch.setattr(
        settings, "get", lambda self, key, *a: None if key == "spark.checkpoint.dir" else found(self, key, *a)
    )
    s, path = spec(2, partitioned=True), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1), 101)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["_dim__work", "dim"]
    assert not list((tmp_path / "_dim__work").glob("tidemark-*"))


def test_queries_use_the_warehouse_when_the_session_names_no_folder(spark, monkeypatch):
    real = type(spark.conf).get

    def unnamed(self, key, *default):
        return default[0] if key == "spark.checkpoint.dir" else real(self, key, *default)

    monkeypatch.setattr(type(spark.conf), "get", unnamed)
    assert queries.scratch(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))
    assert queries.QUERIES["landing_scan"](spark, "/root/testdata/sf0.001").count() == 150


def test_new_column_counts_every_row_as_changed_once(spark, tmp_path):
    path = str(tmp_path / "dim")
    load_batch(spark, spec(2, columns=("k",)), frame(spark, [(1, "a"), (2, "b")]), path, day(1))
    wide = spec(2)
    replace_table(read_final(spark, wide, path), wide, path)
    got = load_batch(spark, wide, frame(spark, [(1, "a"), (2, "b")]), path, day(2))
    assert (got.new, got.changed) == (0, 2)


def test_hot_keys(spark, tmp_path):
    """One key fills a third of the batch, and later a third of the history."""
    path = str(tmp_path / "dim")
    s = TableSpec("dim", ("k",), "k int, n int", 2, on_duplicate_keys="last", dedupe_by="n")
    rows = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int").alias("k"),
        F.col("id").cast("int").alias("n"),
    )
    load_batch(spark, s, rows, path, day(1))
    assert tuples(read_final(spark, s, path).where("k = -1"), "k", "n") == [(-1, 2997)]

    history = read_final(spark, s, path)
    versions = spark.range(0, 1000).select(
        F.lit(-1).alias("k"),
        F.col("id").cast("int").alias("n"),
        F.lit("N").alias("current"),
        F.lit(day(0)).alias("effectiveDate"),
        F.lit(day(1)).alias("endDate"),
        F.lit("h").alias("rowHash"),
    )
    replace_table(history.unionByName(versions), s, path)
    with shuffle_joins(spark), conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        load_batch(spark, s, rows.withColumn("n", F.col("n") + 1), path, day(2))
    table = read_final(spark, s, path)
    assert table.where("k = -1").count() == 1002
    assert table.where("current = 'Y'").count() == 2001
    assert table.where("k = -1 and current = 'N' and rowHash <> 'h'").first()["endDate"] == day(1)


def test_working_files_are_removed(spark, tmp_path):
    s = spec(2, partitioned=True)
    load_batch(spark, s, frame(spark, [(1, "a")]), str(tmp_path / "dim"), day(1), 101)
    assert not list(Path(shared_folder(spark)).glob("tidemark-*"))


@pytest.mark.parametrize("scd_type", [1, 2])
@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("duplicates", ["error", "keep"])
def test_counts_cost_no_job(spark, tmp_path, monkeypatch, scd_type, partitioned, duplicates):
    """Rows by type, partitions and rows for the size checks are seen while staging: as
    many jobs as there are writes, besides those of their exchanges."""
    s, path = spec(scd_type, partitioned=partitioned, on_duplicate_keys=duplicates), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a"), (2, "a")]), path, day(1), 101)

    def refuse(*_):
        raise AssertionError("a job of its own")

    with monkeypatch.context() as patch:
        for name in ("count", "collect", "first", "toArrow", "toPandas"):
            patch.setattr(type(spark.range(1)), name, refuse)
        got = load_batch(spark, s, frame(spark, [(1, "b"), (2, "a"), (3, "n")]), path, day(2), 102)
    assert (got.new, got.changed, got.affected) == (1, 1, (101, 102) if partitioned else ())
    assert {r[:2] for r in tuples(read_final(spark, s, path).where("current = 'Y'"), "k", "v")} == {(1, "b"), (2, "a"), (3, "n")}


def test_a_key_kept_before_is_spread_under_another_policy(spark, tmp_path, monkeypatch):
    """What the table holds is asked of the table, not of the batch's policy."""
    asked = []
    real = skew.heavy_keys
    monkeypatch.setattr(skew, "heavy_keys", lambda df, keys, n=1: asked.append(keys) or real(df, keys, n))
    path = str(tmp_path / "dim")
    load_batch(spark, spec(2, on_duplicate_keys="keep"), frame(spark, [(7, "a")] * 40 + [(1, "a")]), path, day(1))
    with shuffle_joins(spark):
        load_batch(spark, spec(2), frame(spark, [(7, "b"), (2, "n")]), path, day(2))
    assert asked == [["k"]]
    assert read_final(spark, spec(2), path).where("k = 7 and current = 'N'").count() == 40
