"""Which columns a table's row hashes are of: every list that it was loaded under, by name."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import HASH, col, list_name, named_hash
from tidemark.operators.changes import KNOWN
from tidemark.sources.filesystem import Directory
from tidemark.spec import TableSpec

BARE = "bare"  # the file for hashes without a name


@dataclass(frozen=True)
class ColumnList:
    name: str
    mode: str
    columns: tuple[str, ...]


def note_lists(spark: SparkSession, spec: TableSpec, path: str, exists: bool) -> list[ColumnList]:
    """Notes the spec's own column list beside the table and returns all that are noted.

    A list has a file of its own, made before the first row of its name is published, so
    each name in the table is noted. Hashes without a name, of a table that is there
    when its first list is noted, count as made of the spec's columns: lists are
    turned on before the columns change.
    """
    folder = Directory(spark, Directory(spark, path).sibling("__hashes"))
    own = ColumnList(list_name(spec.columns, spec.hash_mode), spec.hash_mode, spec.columns)
    text = json.dumps({"mode": own.mode, "columns": own.columns})
    if exists and not folder.exists():
        folder.make()
        folder.write(f"{folder.path}/{BARE}.json", text)
    file = f"{folder.path}/{own.name}.json"
    if not folder.exists(file):
        folder.make()
        folder.write(file, text)
    found = []
    for name in folder.names("*.json")[1]:
        noted = json.loads(folder.read(f"{folder.path}/{name}"))
        name = name.removesuffix(".json")
        found.append(ColumnList("" if name == BARE else name, noted["mode"], tuple(noted["columns"])))
    if own not in found:
        raise ValueError(f"{path}: the name of the column list {own.columns} is another's")
    return found


def _partial(spec: TableSpec, lists: list[ColumnList]) -> list[ColumnList]:
    """Lists with columns that the spec has no more."""
    return [x for x in lists if not set(x.columns) <= set(spec.columns)]


def _shared(spec: TableSpec, one: ColumnList) -> list[str]:
    """The columns of a list that the spec still has, under their stored names."""
    stored = dict(zip(spec.columns, spec.stored_names, strict=True))
    return [stored[c] for c in one.columns if c in stored]


def with_known(spec: TableSpec, audited: DataFrame, lists: list[ColumnList]) -> DataFrame:
    """Audited landed rows, as they are stored, with the hash of each under every other
    list: what an unchanged row may be stored under. A hash for each list; no shuffle."""
    partial = _partial(spec, lists)
    whole = [x for x in lists if x not in partial and x.name != list_name(spec.columns, spec.hash_mode)]

    def all_of(hashes: list[Column]) -> Column:
        return F.array(*hashes).cast("array<string>")

    landed = all_of([named_hash(x.columns, x.mode, x.name) for x in whole])
    rows = spec.as_stored(audited.withColumn(KNOWN, landed))
    shared = all_of([named_hash(_shared(spec, x), x.mode, x.name) for x in partial])
    return rows.withColumn(KNOWN, F.concat(KNOWN, shared)) if partial else rows


def over_shared(spec: TableSpec, table: DataFrame, lists: list[ColumnList]) -> DataFrame:
    """The stored table, with the hashes of lists that hold columns gone since made anew of
    those that are left, by the stored values. Other rows' hashes are not touched, and
    without such a list no further column is read."""
    hashed = col(HASH)
    for one in _partial(spec, lists):
        named = col(HASH).startswith(f"{one.name}:") if one.name else ~col(HASH).contains(":")
        hashed = F.when(named, named_hash(_shared(spec, one), one.mode, one.name)).otherwise(hashed)
    return table.withColumn(HASH, hashed)
