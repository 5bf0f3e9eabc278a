"""Tables whose readers see whole publishes only.

New content goes into folders of its own within the table, one of each publish for each
partition that it touches, and nothing is moved. A numbered file, written last, names the
folder that each partition is read from: it is the commit. A reader takes the highest one, and keeps
what it has named until ``keep`` later publishes are done. Content is deleted by a later
publish, once no snapshot that is kept names it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import CURRENT, PARTITION
from tidemark.sources.filesystem import Directory
from tidemark.sources.formats import spark_format, table_options, writable
from tidemark.spec import TableSpec

FOLDER = "_snapshots"
VERSION = "_version"
KEEP = 2


@dataclass(frozen=True)
class Snapshot:
    """``places``: the version that each partition folder is read from; '' stands for the
    table where it has no partitions."""

    number: int
    places: dict[str, str]

    def paths(self, path: str, only: Iterable[str] | None = None) -> list[str]:
        chosen = self.places if only is None else [p for p in only if p in self.places]
        return [place_path(path, place, self.places[place]) for place in sorted(chosen)]


def place_path(path: str, place: str, version: str) -> str:
    return "/".join(filter(None, (path.rstrip("/"), place, f"{VERSION}={version}")))


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


class Snapshots:
    """The snapshots of the table at ``path``. Writers hold the table's lock."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._table = Directory(spark, path)
        self.path = self._table.path
        self._folder = f"{self.path}/{FOLDER}"

    def numbers(self) -> list[int]:
        return sorted(int(n.partition(".")[0]) for n in self._table.names("[0-9]*.json", folder=self._folder)[1])

    def read(self, number: int | None = None) -> Snapshot | None:
        """The latest snapshot, or that of a ``number``; None where the table has none."""
        if not self._table.exists(self._folder):
            return None
        numbers = self.numbers()
        if number is not None and number not in numbers:
            raise ValueError(f"{self.path} keeps the snapshots {numbers}, not {number}")
        if not numbers:
            return None
        wanted = numbers[-1] if number is None else number
        return Snapshot(wanted, json.loads(self._table.read(_file(self._folder, wanted))))

    def start(self) -> Snapshot:
        """The latest snapshot; of a table that is not there yet, an empty one is made, so
        that nothing a first load has written is read before its commit."""
        found = self.read()
        if found is None:
            found = Snapshot(0, {})
            self._table.write(_file(self._folder, 0), json.dumps({}))
        return found

    def commit(self, before: Snapshot, places: dict[str, str]) -> Snapshot:
        after = Snapshot(before.number + 1, places)
        self._table.write(_file(self._folder, after.number), json.dumps(places))
        self._spark.catalog.refreshByPath(self.path)
        return after

    def new_version(self) -> str:
        """A name for content to be written, noted first, so that it is found and deleted
        if its publish is cut off."""
        version = f"v{uuid4().hex}"
        self._table.write(f"{self._folder}/writing-{version}", version)
        return version

    def clean(self, keep: int) -> None:
        """Deletes the content of publishes that were cut off, and what only snapshots
        beyond the last ``keep`` name. Each step can be repeated."""
        latest = self.read()
        if latest is None:
            return
        for name in self._table.names("writing-v*", folder=self._folder)[1]:
            version = name.removeprefix("writing-")
            if not name.endswith("_unfinished") and version not in latest.places.values():
                for place in ["", *self._table.names("*=*")[1]]:
                    self._table.delete(place_path(self.path, place, version))
            self._table.delete(f"{self._folder}/{name}")
        numbers = self.numbers()
        kept = {item for n in numbers[-keep:] for item in self.read(n).places.items()}
        for number in numbers[:-keep]:
            for place, version in sorted(set(self.read(number).places.items()) - kept):
                self._table.delete(place_path(self.path, place, version))
            self._table.delete(_file(self._folder, number))

    def written(self, version: str, folder: str | None) -> list[str]:
        """The places that hold content of ``version``."""
        places = [""] if folder is None else self._table.names(f"{folder}=*")[1]
        return [p for p in places if self._table.exists(place_path(self.path, p, version))]


def has_snapshots(spark: SparkSession, spec: TableSpec, path: str) -> bool:
    """The layout of a table that is there is its own; the spec decides for a new one."""
    if Snapshots(spark, path).read() is not None:
        return True
    return spec.snapshots is not None and not Directory(spark, path).names("[^_.]*", most=0)[0]


def write_version(df: DataFrame, spec: TableSpec, path: str, version: str, folder: str | None) -> None:
    """Adds ``df`` to the table's folder under ``version``. No reader sees it yet."""
    rows = writable(df, spec).withColumn(VERSION, F.lit(version))
    places = [VERSION]
    if folder is not None:
        rows, places = rows.withColumnRenamed(PARTITION, folder), [folder, VERSION]
    order = [*places, CURRENT] if spec.scd_type == 2 else places
    writer = rows.sortWithinPartitions(*order).write.format(spark_format(spec.table_format)).options(**table_options(spec))
    writer.mode("append").partitionBy(*places).save(path)
