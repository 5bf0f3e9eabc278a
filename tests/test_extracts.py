"""Landed files are loaded once, whatever loads are cut off."""

from pathlib import Path

import pytest

from tests.helpers import day, spec, tuples
from tests.test_snapshots import Cut, at_each_step
from tidemark import BaseDirs, run_load
from tidemark.sources import Extracts, read_final

KINDS = {
    "merge": {"scd_type": 2, "partitioned": True},
    "plain": {"scd_type": 0, "partitioned": True},
    "snapshots": {"scd_type": 2, "partitioned": True, "snapshots": 2},
}


def made(**options):
    return spec(table_dir="dim", landing_pattern="*.csv", ledger=True, **{"scd_type": 2} | options)


def land(root, **files):
    folder = Path(root) / "in" / "dim"
    folder.mkdir(parents=True, exist_ok=True)
    for name, rows in files.items():
        (folder / f"{name}.csv").write_text("k,v\n" + rows)


def dirs(root):
    return BaseDirs(f"{root}/in", f"{root}/out")


def loaded(spark, path):
    return sorted(r["path"].rpartition("/")[2] for r in Extracts(spark, path, day(0)).loaded().collect())


def test_each_file_is_loaded_once(spark, tmp_path):
    s = made(scd_type=1)
    land(tmp_path, **{"a [1]{x}": "1,a\n2,a\n"})
    got = run_load(spark, s, dirs(tmp_path), day(1))
    assert (got.extracts, got.new) == (1, 2)
    land(tmp_path, b="1,b\n")
    got = run_load(spark, s, dirs(tmp_path), day(2))
    # the old file with another value of key 1 would be a repeated key
    assert (got.extracts, got.new, got.changed) == (1, 0, 1)
    got = run_load(spark, s, dirs(tmp_path), day(3))
    assert (got.extracts, got.new, got.changed) == (0, 0, 0)
    land(tmp_path, c="1,b\n")  # a file that changes nothing is loaded none the less
    assert run_load(spark, s, dirs(tmp_path), day(4)).extracts == 1
    land(tmp_path, b="1,bb\n")  # another size under a name that was loaded
    got = run_load(spark, s, dirs(tmp_path), day(5))
    assert (got.extracts, got.changed) == (1, 1)
    assert loaded(spark, got.path) == ["a [1]{x}.csv", "b.csv", "b.csv", "c.csv"]
    assert tuples(read_final(spark, s, got.path), "k", "v") == [(1, "bb"), (2, "a")]


def test_a_failed_load_leaves_its_files_to_the_next(spark, tmp_path):
    s = made()
    land(tmp_path, a="1,a\n1,b\n")
    with pytest.raises(Exception, match="duplicate merge key"):
        run_load(spark, s, dirs(tmp_path), day(1))
    land(tmp_path, a="1,a\n")
    assert run_load(spark, s, dirs(tmp_path), day(1)).extracts == 1
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_dim__extracts", "dim"]
    assert len([p for p in (tmp_path / "out" / "_dim__extracts").iterdir() if not p.name.startswith(".")]) == 1


@pytest.mark.parametrize("kind", KINDS)
def test_a_load_cut_off_neither_skips_nor_repeats(spark, tmp_path, monkeypatch, kind):
    s = made(bad_rows="quarantine", **KINDS[kind])
    refused = f"{tmp_path}/{{}}/out/_dim__rejects"

    def build(name):
        root = tmp_path / name
        land(root, a="1,a\n2,a\n")
        run_load(spark, s, dirs(root), day(1), 101)
        land(root, b="1,b\n3,b\noops,x\n")
        return root

    def state(root):
        path = s.table_path(dirs(root).tables)
        return tuples(read_final(spark, s, path)), loaded(spark, path)

    root = build("uncut")
    with monkeypatch.context() as patch:
        steps = at_each_step(patch, lambda n: None)
        run_load(spark, s, dirs(root), day(2), 102)
    want = state(root)
    assert want[1] == ["a.csv", "b.csv"] and len(want[0]) == 4
    for last in sorted({2, steps[0] // 3, *range(2 * steps[0] // 3, steps[0], 5)}):
        root = build(f"cut{last}")

        def cut(n, last=last):
            if n >= last:
                raise Cut

        with monkeypatch.context() as patch:
            at_each_step(patch, cut)
            with pytest.raises(Cut):
                run_load(spark, s, dirs(root), day(2), 102)
        run_load(spark, s, dirs(root), day(2), 102)
        assert state(root) == want, last
        assert spark.read.parquet(refused.format(root.name)).count() == 1
        assert run_load(spark, s, dirs(root), day(3), 103).extracts == 0
        assert state(root) == want


def test_plain_overwrite_takes_the_new_files(spark, tmp_path):
    s = made(scd_type=0, save_mode="overwrite")
    land(tmp_path, a="1,a\n")
    run_load(spark, s, dirs(tmp_path), day(1))
    land(tmp_path, b="2,b\n")
    got = run_load(spark, s, dirs(tmp_path), day(2))
    run_load(spark, s, dirs(tmp_path), day(3))
    assert tuples(read_final(spark, s, got.path), "k", "v") == [(2, "b")]


def test_what_a_ledger_does_not_go_with(spark):
    for options in ({"table_format": "delta"}, {"scd_type": 0, "save_mode": "ignore"}):
        with pytest.raises(ValueError, match="ledger"):
            made(**options)
