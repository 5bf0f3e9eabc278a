import json
import os
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tests.helpers import conf, day, frame, plan_of, spec, stored, tuples
from tidemark import TableSpec, load_batch
from tidemark.functions import with_audit
from tidemark.operators import MergeParts
from tidemark.sources import (
    partition_path,
    publish_partitions,
    read_final,
    read_landing,
    read_partitions,
    recover_table,
    replace_table,
    save_rows,
    shared_folder,
)
from tidemark.sources.filesystem import Content, Directory
from tidemark.sources.tables import too_many_files


def data_files(path):
    return sorted(p for p in Path(path).rglob("part-*") if p.is_file())


def partitions(path):
    return sorted(p.name for p in Path(path).glob("partitionKey=*"))


# --- landed files ----------------------------------------------------------


def test_landing_scan_takes_the_glob_under_the_schema(spark, tmp_path):
    folder = tmp_path / "crm" / "dim"
    folder.mkdir(parents=True)
    (folder / "dim_1.csv").write_text('k,v\n1,"a,b"\n2,\n3\n')
    (folder / "dim_2.csv").write_text("k,v\n4,d\n")
    (folder / "other.csv").write_text("k,v\n5,e\n")
    s = spec(app_dir="crm", table_dir="dim", landing_pattern="dim_*.csv")
    got = read_landing(spark, s, str(tmp_path))
    assert dict(got.dtypes) == {"k": "int", "v": "string"}
    assert tuples(got) == [(1, "a,b"), (2, None), (3, None), (4, "d")]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "txt"])
def test_landing_formats(spark, tmp_path, fmt):
    rows = frame(spark, [(1, "a"), (2, None)])
    writer = rows.write.option("header", True).option("sep", "\t")
    getattr(writer, "csv" if fmt == "txt" else fmt)(str(tmp_path / "dim" / "x"))
    s = spec(table_dir="dim", landing_pattern="x", landing_format=fmt, landing_delimiter="\t")
    assert tuples(read_landing(spark, s, str(tmp_path))) == [(1, "a"), (2, None)]


def test_multiline_landing(spark, tmp_path):
    (tmp_path / "dim").mkdir()
    (tmp_path / "dim" / "a.csv").write_text('k,v\n1,"a\nb"\n')
    s = spec(table_dir="dim", landing_pattern="*.csv", landing_multiline=True)
    assert tuples(read_landing(spark, s, str(tmp_path))) == [(1, "a\nb")]


# --- formats ---------------------------------------------------------------

ODD = "b boolean, d date, t timestamp, n timestamp_ntz, m decimal(12,2), f double, s string"
ODD_ROWS = [
    (True, day(0), datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2024, 1, 2, 3, 4, 5, 1), Decimal("1.50"), 0.1, text)
    for text in (
        *("", " padded ", "a|b", 'say "hi"', "back\\slash", "ends in \\", '"', "''", "#x", "é漢"),
        *('\\"', "null", ",", "\\", '|"\\'),
    )
] + [(None,) * 7]


@pytest.mark.parametrize("fmt", ["csv", "txt", "parquet", "orc"])
def test_table_formats_give_back_what_was_written(spark, tmp_path, fmt):
    rows = spark.createDataFrame(ODD_ROWS, ODD)
    s = TableSpec("t", (), ODD, 0, table_format=fmt, table_delimiter="|")
    table = with_audit(rows, s.columns, day(1))
    replace_table(table, s, str(tmp_path / "t"))
    back = read_final(spark, s, str(tmp_path / "t"))
    assert back.schema == s.final_struct
    assert tuples(back) == tuples(table)


def test_multiline_values_in_text_tables(spark, tmp_path):
    rows = frame(spark, [(1, "a\nb"), (2, "c\r\nd")])
    s = spec(0, table_format="csv")
    with pytest.raises(PySparkException, match="line end"):
        load_batch(spark, s, rows, str(tmp_path / "a"), day(1))
    s = spec(0, table_format="csv", table_multiline=True)
    load_batch(spark, s, rows, str(tmp_path / "b"), day(1))
    assert tuples(read_final(spark, s, str(tmp_path / "b")), "k", "v") == [(1, "a\nb"), (2, "c\r\nd")]


def test_null_marker_as_a_value_is_refused_in_text_tables(spark, tmp_path):
    with pytest.raises(PySparkException, match="NULL marker"):
        load_batch(spark, spec(0, table_format="csv"), frame(spark, [(1, "\\N")]), str(tmp_path / "t"), day(1))


def test_plain_dialect_is_sparks_own_csv(spark, tmp_path):
    s = spec(0, table_format="csv", text_dialect="plain")
    load_batch(spark, s, frame(spark, [(1, ""), (2, "b")]), str(tmp_path / "t"), day(1))
    assert tuples(read_final(spark, s, str(tmp_path / "t")), "k", "v") == [(1, None), (2, "b")]
    text = "".join(p.read_text() for p in data_files(tmp_path / "t"))
    assert text.splitlines()[0].startswith('1,"",Y,2024-01-02,,')


# --- plain loads -----------------------------------------------------------


def test_save_modes(spark, tmp_path):
    def run(mode, rows, partition=None):
        s = spec(0, save_mode=mode, partitioned=partition is not None)
        path = str(tmp_path / ("p" if partition else "t"))
        load_batch(spark, s, frame(spark, rows), path, day(1), partition)
        return tuples(read_final(spark, s, path), "k", *(["partitionKey"] if partition else []))

    assert run("errorifexists", [(1, "a")]) == [(1,)]
    with pytest.raises(AnalysisException):
        run("errorifexists", [(2, "a")])
    assert run("append", [(2, "b")]) == [(1,), (2,)]
    assert run("ignore", [(3, "c")]) == [(1,), (2,)]
    assert run("overwrite", [(4, "d")]) == [(4,)]

    assert run("errorifexists", [(1, "a")], 10) == [(1, 10)]
    assert run("errorifexists", [(2, "b")], 20) == [(1, 10), (2, 20)]
    assert run("append", [(3, "c")], 20) == [(1, 10), (2, 20), (3, 20)]
    assert run("ignore", [(9, "z")], 20) == [(1, 10), (2, 20), (3, 20)]
    assert run("overwrite", [(4, "d")], 20) == [(1, 10), (4, 20)]
    assert run("overwrite", [], 20) == [(1, 10)]


# --- partitions ------------------------------------------------------------

ROWS = [(k, "v", "Y", 0, None, 10 + (k + 2) % 4) for k in range(1, 13)]


@pytest.fixture
def partitioned(spark, tmp_path):
    s = spec(1, partitioned=True)
    path = str(tmp_path / "dim")
    replace_table(stored(spark, ROWS, partitioned=True).select(*s.final_struct.names), s, path)
    return s, path


def test_partition_scan_is_pruned(spark, partitioned):
    s, path = partitioned
    df = read_partitions(spark, s, path, [10, 12])
    assert {r[0] for r in tuples(df, "partitionKey")} == {10, 12}
    assert "partitionKey" in plan_of(df).split("PartitionFilters: [")[1].split("]")[0]
    assert {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()} >= {"partitionKey=10"}
    assert read_partitions(spark, s, path, []).count() == 0


def test_partitions_are_overwritten_from_their_own_rows(spark, partitioned):
    s, path = partitioned
    held = read_partitions(spark, s, path, [10, 11])
    untouched = {p: p.stat().st_mtime_ns for p in data_files(f"{path}/partitionKey=12")}
    emptied = publish_partitions(MergeParts(None, held.withColumn("v", F.lit("w"))), s, path, [10, 11])
    assert emptied == []
    assert set(tuples(read_final(spark, s, path), "k", "v")) == {
        (k, "w" if k % 4 in (2, 3) else "v") for k in range(1, 13)
    }
    assert untouched == {p: p.stat().st_mtime_ns for p in data_files(f"{path}/partitionKey=12")}


def test_emptied_partition_is_removed(spark, partitioned):
    s, path = partitioned
    held = read_partitions(spark, s, path, [10, 11])
    moved = held.withColumn("partitionKey", F.lit(11))
    assert publish_partitions(MergeParts(None, moved), s, path, [10, 11]) == [10]
    assert partitions(path) == ["partitionKey=11", "partitionKey=12", "partitionKey=13"]
    assert len(tuples(read_final(spark, s, path))) == len(ROWS)


def test_type2_never_removes_a_partition(spark, partitioned):
    _, path = partitioned
    s = spec(2, partitioned=True)
    held = read_partitions(spark, s, path, [10, 11])
    with pytest.raises(RuntimeError, match="no rows"):
        publish_partitions(MergeParts(None, held.where("partitionKey = 10")), s, path, [10, 11])
    assert len(tuples(read_final(spark, s, path))) == len(ROWS)


def test_big_partition_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 40000, 1, 8).select(
        F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    s = spec(2, partitioned=True)
    path = str(tmp_path / "dim")
    with conf(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256k",
        # as many staged files, and so tasks before the rebalance, as there are cores
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        load_batch(spark, s, rows, path, day(1), 10)
        load_batch(spark, s, rows.withColumn("v", F.lit("x")), path, day(2), 11)
    assert len(data_files(f"{path}/partitionKey=11")) > 1
    assert read_final(spark, s, path).count() == 80000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_files_per_partition_is_an_upper_bound(spark, tmp_path, adaptive):
    with conf(spark, spark__sql__adaptive__enabled=adaptive):
        rows = spark.range(0, 1000, 1, 8).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
        s = spec(2, partitioned=True, files_per_partition=2)
        path = str(tmp_path / "dim")
        load_batch(spark, s, rows, path, day(1), 10)
        load_batch(spark, s, rows.withColumn("v", F.lit("b")), path, day(2), 11)
        for p in (10, 11):
            assert 1 <= len(data_files(f"{path}/partitionKey={p}")) <= 2
        assert read_final(spark, s, path).count() == 2000


def test_without_adaptive_execution(spark, tmp_path):
    with conf(spark, spark__sql__adaptive__enabled="false"):
        rows = frame(spark, [(k, "a") for k in range(50)])
        s = spec(1, partitioned=True)
        path = str(tmp_path / "dim")
        load_batch(spark, s, rows, path, day(1), 10)
        load_batch(spark, s, rows.withColumn("v", F.lit("b")), path, day(2), 11)
        assert partitions(path) == ["partitionKey=11"]
        assert read_final(spark, s, path).count() == 50


def test_compaction_rule():
    mb = 1024 * 1024
    assert not too_many_files([Content(1, mb), Content(2, 2 * mb)])
    assert not too_many_files([Content(40, 40 * 128 * mb)])
    assert too_many_files([Content(5, 5 * mb)])
    assert not too_many_files([]) and not too_many_files([Content(0, 0)])


# --- whole tables ----------------------------------------------------------


def test_table_is_replaced_from_its_own_rows(spark, tmp_path):
    s, path = spec(2), str(tmp_path / "dim")
    table = stored(spark, [r[:5] for r in ROWS]).select(*s.final_struct.names)
    replace_table(table, s, path)
    replace_table(read_final(spark, s, path).where("k > 6"), s, path)
    replace_table(read_final(spark, s, path).withColumn("v", F.lit("w")), s, path)
    assert tuples(read_final(spark, s, path), "k", "v") == sorted([(k, "w") for k in range(7, 13)], key=repr)
    assert [p.name for p in tmp_path.iterdir()] == ["dim"]


def write_marker(path, text):
    Path(path).mkdir()
    (Path(path) / "part-0").write_text(text)


@pytest.mark.parametrize(
    ("there", "expected"),
    [
        ({"dim": "new", "_dim__prev": "old"}, "new"),
        ({"_dim__next": "half", "_dim__prev": "old"}, "old"),
        ({"_dim__prev": "old"}, "old"),
        ({"dim": "old", "_dim__next": "half"}, "old"),  # while writing
        ({"dim": "old"}, "old"),
    ],
)
def test_nothing_is_decided_without_a_note(spark, tmp_path, there, expected):
    for name, text in there.items():
        write_marker(tmp_path / name, text)
    recover_table(spark, str(tmp_path / "dim"))
    assert (tmp_path / "dim" / "part-0").read_text() == expected
    assert not (tmp_path / "_dim__next").exists()
    # an old copy beside a table is not ours to delete
    assert (tmp_path / "_dim__prev").exists() == ("dim" in there and "_dim__prev" in there)


def put(folder, files):
    folder.mkdir(parents=True)
    for name, text in files.items():
        (folder / name).write_text(text)


OLD, NEW = {"part-0": "old", "part-1": "old"}, {"part-0": "new!", "part-1": "newer!", "part-2": ""}


def some(files, n):
    return dict(list(files.items())[:n])


@pytest.mark.parametrize(
    ("there", "staged"),
    [
        (OLD, NEW),  # noted, nothing moved
        (some(OLD, 1), NEW),  # the old files half deleted
        (None, NEW),
        (some(NEW, 1), NEW),  # a rename that copies, cut off while copying
        ({"part-0": "ne"} | some(OLD, 0), NEW),
        (NEW, NEW),  # copied, nothing deleted yet
        (NEW, some(NEW, 2)),  # copied, the source half deleted
        (NEW, None),
    ],
)
@pytest.mark.parametrize("place", ["", "partitionKey=7"])
def test_a_publish_cut_off_is_finished(spark, tmp_path, there, staged, place):
    table = Directory(spark, str(tmp_path / "dim"))
    size = (len(NEW), sum(map(len, NEW.values())))
    if there is not None:
        put(tmp_path / "dim" / place, there)
    if staged is not None:
        put(tmp_path / "_dim__next" / place, staged)
    if place:
        put(tmp_path / "dim" / "partitionKey=8", OLD)  # goes
        put(tmp_path / "dim" / "partitionKey=9", OLD)  # stays
    moves = [(place, *size)] + ([("partitionKey=8",)] if place else [])
    table.write(table.sibling("__swap"), json.dumps(moves))
    for _ in range(2):
        recover_table(spark, str(tmp_path / "dim"))
        assert {p.name: p.read_text() for p in (tmp_path / "dim" / place).glob("part-*")} == NEW
        assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["dim"]
    if place:
        assert sorted(p.name for p in (tmp_path / "dim").iterdir()) == ["partitionKey=7", "partitionKey=9"]


def test_two_broken_copies_are_left_alone(spark, tmp_path):
    table = Directory(spark, str(tmp_path / "dim"))
    put(tmp_path / "dim", some(NEW, 1))
    put(tmp_path / "_dim__next", some(NEW, 2))
    table.write(table.sibling("__swap"), json.dumps([("", 3, 10)]))
    with pytest.raises(RuntimeError, match="whole"):
        recover_table(spark, str(tmp_path / "dim"))
    assert (tmp_path / "dim").exists() and (tmp_path / "_dim__next").exists()


@pytest.mark.parametrize("scd_type", [1, 2])
@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("cut", range(4))
def test_a_load_cut_off_anywhere_and_repeated_is_the_load(spark, tmp_path, monkeypatch, scd_type, partitioned, cut):
    """Cut off before the note, and after each rename or deletion of the publish."""
    s = spec(scd_type, partitioned=partitioned)
    first = frame(spark, [(1, "a"), (2, "a")])
    second = frame(spark, [(1, "b"), (2, "b"), (3, "c")])
    for name in ("cut", "whole"):
        load_batch(spark, s, first, f"{tmp_path}/{name}", day(1), 101)
    load_batch(spark, s, second, f"{tmp_path}/whole", day(5), 102)
    calls = [0]

    def counted(real):
        def call(self, *args):
            calls[0] += self.path.endswith("/cut")
            if calls[0] > cut and self.path.endswith("/cut"):
                raise KeyboardInterrupt
            return real(self, *args)

        return call

    with monkeypatch.context() as patch:
        if cut == 0:
            patch.setattr(Directory, "write", lambda self, path, text: (_ for _ in ()).throw(KeyboardInterrupt()))
        else:
            written = Directory.write

            def write_then_count(self, path, text):
                written(self, path, text)
                patch.setattr(Directory, "rename", counted(Directory.rename))
                patch.setattr(Directory, "delete", counted(Directory.delete))

            patch.setattr(Directory, "write", write_then_count)
        with pytest.raises(KeyboardInterrupt):
            load_batch(spark, s, second, f"{tmp_path}/cut", day(5), 102)
    load_batch(spark, s, second, f"{tmp_path}/cut", day(5), 102)
    assert tuples(read_final(spark, s, f"{tmp_path}/cut")) == tuples(read_final(spark, s, f"{tmp_path}/whole"))


@pytest.mark.parametrize("scd_type", [1, 2])
def test_partition_folders_keep_their_spelling(spark, tmp_path, scd_type):
    s, path = spec(scd_type, partitioned=True), str(tmp_path / "dim")
    for p, rows in ((101, [(1, "a"), (2, "a")]), (102, [(3, "a")])):
        audited = with_audit(frame(spark, rows), s.columns, day(0))
        audited.write.parquet(f"{path}/partitionkey={p}")
    load_batch(spark, s, frame(spark, [(1, "b"), (4, "n")]), path, day(1), 103)
    assert {p.name.partition("=")[0] for p in Path(path).glob("*=*")} == {"partitionkey"}
    got = tuples(read_final(spark, s, path).where("current = 'Y'"), "k", "v", "partitionKey")
    assert got == [(1, "b", 103), (2, "a", 101), (3, "a", 102), (4, "n", 103)]
    assert tuples(read_partitions(spark, s, path, [102]), "k") == [(3,)]
    (tmp_path / "dim" / "partitionKey=104").mkdir()
    for use in (lambda: read_final(spark, s, path), lambda: load_batch(spark, s, frame(spark, []), path, day(2), 104)):
        with pytest.raises(ValueError, match="spellings"):
            use()


def test_new_partitions_are_named_by_the_spec(spark, tmp_path):
    s = spec(0, partitioned=True, partition_folder="partitionkey")
    load_batch(spark, s, frame(spark, [(1, "a")]), str(tmp_path / "dim"), day(1), 101)
    assert [p.name for p in (tmp_path / "dim").iterdir() if "=" in p.name] == ["partitionkey=101"]


def test_calls_per_partition_do_not_grow_with_its_files(spark, tmp_path, monkeypatch):
    calls = []
    real = Directory.content
    monkeypatch.setattr(Directory, "content", lambda self, path=None: calls.append(path) or real(self, path))
    for files in (1, 30):
        s, path = spec(1, partitioned=True), str(tmp_path / f"dim{files}")
        rows = spark.range(0, 60, 1, files).selectExpr("cast(id as int) k", "'a' v")
        with_audit(rows, s.columns, day(0)).write.parquet(partition_path(path, 101))
        calls.append("start")
        load_batch(spark, s, frame(spark, [(1, "b")]), path, day(1), 102)
    first, second = " ".join(map(str, calls)).split("start")[1:]
    assert len(first.split()) == len(second.split())


def test_whole_partitioned_table_gets_few_files_per_partition(spark, tmp_path):
    s, path = spec(1, partitioned=True), str(tmp_path / "dim")
    rows = spark.range(0, 800, 1, 8).selectExpr("cast(id as int) k", "'a' v")
    rows = with_audit(rows, s.columns, day(0), 1).withColumn("partitionKey", (F.col("k") % 5).cast("int"))
    replace_table(rows, s, path)
    assert all(len(data_files(p)) == 1 for p in Path(path).glob("partitionKey=*"))


# --- landed files that do not fit ------------------------------------------


def landed(spark, tmp_path, text, **options):
    folder = tmp_path / "dim"
    folder.mkdir(exist_ok=True)
    (folder / "x.csv").write_text(text)
    s = spec(table_dir="dim", landing_pattern="*.csv", **options)
    return read_landing(spark, s, str(tmp_path))


def test_bad_values_fail_or_are_null(spark, tmp_path):
    text = 'k,v\n1,a\noops,b\n" ",c\n"",d\n5\n'
    with pytest.raises(PySparkException, match="oops"):
        landed(spark, tmp_path, text).collect()
    got = landed(spark, tmp_path, text, bad_rows="null")
    assert tuples(got) == sorted([(1, "a"), (None, "b"), (None, "c"), (None, "d"), (5, None)], key=repr)


def test_typed_values_of_landed_text(spark, tmp_path):
    ddl = "k int, v string, d date, t timestamp_ntz, m decimal(12,2), b boolean, f double"
    header = "k,v,d,t,m,b,f"
    text = f"{header}\n7,x,2024-02-29,2024-02-29 01:02:03.5,-12.50,true,1e-3\n8,,,,,,\n"
    folder = tmp_path / "dim"
    folder.mkdir()
    (folder / "x.csv").write_text(text)
    s = TableSpec("dim", ("k",), ddl, 2, table_dir="dim", landing_pattern="*.csv")
    got = read_landing(spark, s, str(tmp_path)).orderBy("k").collect()
    assert [f.simpleString() for f in s.raw_struct] == [f"{c}:{t}" for c, t in read_landing(spark, s, str(tmp_path)).dtypes]
    full = (7, "x", datetime(2024, 2, 29).date(), datetime(2024, 2, 29, 1, 2, 3, 500000), Decimal("-12.50"), True, 0.001)
    assert tuple(got[0]) == full
    assert tuple(got[1]) == (8, *[None] * 6)


def test_headers_are_checked(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        landed(spark, tmp_path, "v,k\na,1\n").collect()
    assert tuples(landed(spark, tmp_path, "K,V\n1,a\n")) == [(1, "a")]
    assert tuples(landed(spark, tmp_path, "id,name\n1,a\n", check_header=False)) == [(1, "a")]


def test_leftovers_next_to_the_table_are_cleared(spark, tmp_path):
    put(tmp_path / "_dim__work" / "tidemark-1", OLD)
    load_batch(spark, spec(2), frame(spark, [(1, "a")]), str(tmp_path / "dim"), day(1))
    assert not (tmp_path / "_dim__work").exists()


def test_staged_rows_of_a_load_that_died_are_cleared_by_the_table_s_next(spark, tmp_path, monkeypatch):
    def staged():
        return set(Path(shared_folder(spark)).glob("tidemark-*"))

    s, path, other, before = spec(2), str(tmp_path / "dim"), str(tmp_path / "dim2"), staged()
    with monkeypatch.context() as patch:
        patch.setattr(Directory, "delete", lambda *_: None)
        load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1))
    assert len(staged() - before) == 2
    load_batch(spark, s, frame(spark, [(1, "a")]), other, day(1))
    assert len(staged() - before) == 2
    load_batch(spark, s, frame(spark, [(1, "b")]), path, day(2))
    assert not staged() - before
    assert tuples(read_final(spark, s, path).where("current = 'Y'"), "k", "v") == [(1, "b")]


def test_failed_merge_leaves_the_table(spark, tmp_path):
    s, path = spec(2), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1))
    with pytest.raises(PySparkException):
        load_batch(spark, s, frame(spark, [(2, "b"), (2, "c")]), path, day(2))
    assert tuples(read_final(spark, s, path), "k") == [(1,)]
    assert not list(Path(shared_folder(spark)).glob("tidemark-*"))


def test_plain_save_of_a_repartitioned_frame(spark, tmp_path):
    s = spec(0, files_per_partition=1, save_mode="overwrite")
    rows = with_audit(spark.range(0, 100, 1, 8).selectExpr("cast(id as int) k", "'a' v"), s.columns, day(1))
    save_rows(rows, s, str(tmp_path / "t"))
    assert len(data_files(tmp_path / "t")) == 1


def test_work_folder_is_the_session_s_or_next_to_the_table(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    table = Directory(spark, str(tmp_path / "dim"))
    assert table.sibling("__work").endswith("/_dim__work")
