"""Readers of a table with snapshots see whole publishes, whatever the writer is at."""

import random
from pathlib import Path

import pytest

from tests.helpers import Model, day, frame, spec, stored, tuples
from tidemark import load_batch
from tidemark.operators import MergeParts
from tidemark.sources import publish_partitions, read_final, read_partitions, replace_table
from tidemark.sources.filesystem import Directory
from tidemark.sources.snapshots import Snapshots

STEPS = ("write", "rename", "delete", "create_new")


class Cut(Exception):
    pass


def versioned(scd_type=2, **options):
    return spec(scd_type, snapshots=2, **options)


def versions(path):
    return sorted(p.relative_to(path) for p in Path(path).rglob("_version=*"))


def at_each_step(monkeypatch, act):
    """Calls ``act`` with a running number before each change of the file system."""
    count = [0]
    for name in STEPS:
        plain = getattr(Directory, name)

        def step(self, *args, _plain=plain):
            count[0] += 1
            act(count[0])
            return _plain(self, *args)

        monkeypatch.setattr(Directory, name, step)
    return count


@pytest.mark.parametrize(
    ("scd_type", "partitioned", "fmt"), [(1, False, "parquet"), (1, True, "csv"), (2, False, "csv"), (2, True, "parquet")]
)
def test_loads_come_to_the_model(spark, tmp_path, scd_type, partitioned, fmt):
    random.seed(f"{scd_type}{partitioned}{fmt}")
    s, model, path = versioned(scd_type, partitioned=partitioned, table_format=fmt), Model(scd_type), str(tmp_path / "dim")
    earlier = []
    for n in range(4):
        rows = [(k, random.choice("ab")) for k in random.sample(range(12), 8)]
        load_batch(spark, s, frame(spark, rows), path, day(10 * n), 100 + n)
        model.load(rows, 10 * n, 100 + n)
        # a reader of the plain spec finds the snapshots too
        assert tuples(read_final(spark, spec(scd_type, partitioned=partitioned, table_format=fmt), path)) == model.table(partitioned)
        earlier.append((Snapshots(spark, path).read().number, model.table(partitioned)))
    assert len(Snapshots(spark, path).numbers()) == 3
    for number, rows in earlier[-2:]:
        assert tuples(read_final(spark, s, path, snapshot=number)) == rows
    with pytest.raises(ValueError, match="keeps the snapshots"):
        read_final(spark, s, path, snapshot=earlier[0][0])


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_read_at_any_step_is_whole(spark, tmp_path, monkeypatch, partitioned):
    s, path = versioned(partitioned=partitioned), str(tmp_path / "dim")
    for n in range(3):
        load_batch(spark, s, frame(spark, [(k, "ab"[n % 2]) for k in range(4)]), path, day(n), 100 + n)
    old = tuples(read_final(spark, s, path))
    held = read_final(spark, s, path)
    seen = []

    def read(_):
        seen.append(tuples(read_final(spark, s, path)))
        assert tuples(held) == old  # files that a reader has listed stay

    with monkeypatch.context() as patch:
        at_each_step(patch, read)
        load_batch(spark, s, frame(spark, [(0, "z"), (9, "z")]), path, day(9), 109)
    new = tuples(read_final(spark, s, path))
    assert len(new) == len(old) + 2
    switch = seen.index(new) if new in seen else len(seen)
    assert len(seen) > 4 and seen == [old] * switch + [new] * (len(seen) - switch)
    assert tuples(held) == old


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_load_cut_off_anywhere_is_repeated(spark, tmp_path, monkeypatch, partitioned):
    s, rows = versioned(partitioned=partitioned), frame(spark, [(0, "z"), (9, "z")])
    first = frame(spark, [(k, "a") for k in range(4)])

    def build(path):
        for n in range(2):
            load_batch(spark, s, first if n == 0 else frame(spark, [(1, "b")]), path, day(n), 100 + n)

    uncut = str(tmp_path / "uncut")
    build(uncut)
    with monkeypatch.context() as patch:
        steps = at_each_step(patch, lambda n: None)
        load_batch(spark, s, rows, uncut, day(9), 109)
    want, old = tuples(read_final(spark, s, uncut)), tuples(read_final(spark, s, uncut, snapshot=2))
    for last in range(2 + partitioned, steps[0], 5):
        path = str(tmp_path / f"cut{last}")
        build(path)

        def cut(n, last=last):
            if n >= last:
                raise Cut

        with monkeypatch.context() as patch:
            at_each_step(patch, cut)
            with pytest.raises(Cut):
                load_batch(spark, s, rows, path, day(9), 109)
        assert tuples(read_final(spark, s, path)) in (old, want)
        load_batch(spark, s, rows, path, day(9), 109)
        assert tuples(read_final(spark, s, path)) == want
        load_batch(spark, s, frame(spark, [(50, "n")]), path, day(10), 110)
        named = {v for n in Snapshots(spark, path).numbers() for v in Snapshots(spark, path).read(n).places.values()}
        assert {p.name.partition("=")[2] for p in versions(path)} <= named
        assert not list(Path(path).glob("_snapshots/writing-*"))[1:]


def test_a_first_load_cut_off_shows_nothing(spark, tmp_path, monkeypatch):
    s, path = versioned(partitioned=True), str(tmp_path / "dim")
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "commit", lambda *_: (_ for _ in ()).throw(Cut()))
        with pytest.raises(Cut):
            load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1), 101)
    assert versions(path) and tuples(read_final(spark, s, path)) == []
    load_batch(spark, s, frame(spark, [(1, "b")]), path, day(2), 102)
    assert tuples(read_final(spark, s, path), "k", "v", "partitionKey") == [(1, "b", 102)]


def test_a_table_keeps_its_layout(spark, tmp_path):
    rows = stored(spark, [(1, "a", "Y", 0, None, 10), (2, "a", "Y", 0, None, 11)], partitioned=True)
    plain, s = spec(2, partitioned=True), versioned(partitioned=True)
    for first, second, name in ((plain, s, "plain"), (s, plain, "versioned")):
        path = str(tmp_path / name)
        replace_table(rows.select(*plain.final_struct.names), first, path)
        load_batch(spark, second, frame(spark, [(1, "z")]), path, day(5), 12)
        assert bool(versions(path)) == (first is s)
    got = [tuples(read_final(spark, s, str(tmp_path / n))) for n in ("plain", "versioned")]
    assert got[0] == got[1] and len(got[0]) == 3
    with pytest.raises(ValueError, match="keeps no snapshots"):
        read_final(spark, plain, str(tmp_path / "plain"), snapshot=1)


def test_partitions_that_go_and_partitions_of_none(spark, tmp_path):
    s, path = versioned(1, partitioned=True), str(tmp_path / "dim")
    load_batch(spark, s, frame(spark, [(1, "a")]), path, day(1), 101)
    load_batch(spark, s, frame(spark, [(2, "a")]), path, day(2), 102)
    got = load_batch(spark, s, frame(spark, [(1, "b")]), path, day(3), 103)
    assert got.emptied == (101,)
    assert tuples(read_final(spark, s, path), "k", "v", "partitionKey") == [(1, "b", 103), (2, "a", 102)]
    assert tuples(read_partitions(spark, s, path, [101, 102]), "k") == [(2,)]
    assert read_partitions(spark, s, path, [7]).count() == 0
    outside = read_final(spark, s, path)
    before = Snapshots(spark, path).read()
    with pytest.raises(RuntimeError, match="outside"):
        publish_partitions(MergeParts(None, outside), s, path, [102])
    assert Snapshots(spark, path).read() == before


def test_what_snapshots_do_not_go_with(spark):
    for options in ({"buckets": 4}, {"key_index": True, "partitioned": True}, {"scd_type": 0}, {"table_format": "delta"}):
        with pytest.raises(ValueError, match="snapshots"):
            versioned(**options)
    with pytest.raises(ValueError, match="at least 2"):
        spec(2, snapshots=1)
