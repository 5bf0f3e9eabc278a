"""The ledger of a table: which landed files it holds, by name, size and time."""

from __future__ import annotations

import re
from datetime import date
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.filesystem import Directory
from tidemark.sources.snapshots import Snapshots

SCHEMA = "path string, length long, modificationTime timestamp"
PENDING = "_pending-"
VERSION_OF = "_version-"


class Move(NamedTuple):
    """A folder that goes with a publish, and what it holds."""

    source: str
    target: str
    files: int
    size: int


class Extracts:
    """Landed files that are loaded with one publish, and the table's ledger of earlier ones.

    The ledger is a small table beside the dimension, a folder for each load. A load writes
    its folder ahead, under a name that is not read, and the note that commits the publish
    names its move: it is rolled forward with the table, or neither takes place. So is
    the folder of the load's refused rows. Writers hold the table's lock.
    """

    def __init__(self, spark: SparkSession, path: str, run_date: date):
        self.spark, self._path = spark, path
        self._dir = Directory(spark, Directory(spark, path).sibling("__extracts"))
        self._rejects = Directory(spark, path).sibling("__rejects")
        self.name = f"{run_date.isoformat()}-{uuid4().hex}"

    def loaded(self) -> DataFrame:
        """(path, length, modificationTime) of the landed files that the table holds."""
        if not self._dir.names("load=*", most=0)[0]:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self._dir.path}/load=*")

    def begin(self, glob: str) -> list[str]:
        """Settles earlier loads that were cut off, and notes as this load's the files of
        ``glob`` that the ledger does not hold: another name, size or time. Returns
        their paths. Files are listed, not read."""
        self._settle()
        landed = self.spark.read.format("binaryFile").load(glob).select("path", "length", "modificationTime")
        names = ["path", "length", "modificationTime"]
        fresh = landed.join(self.loaded(), names, "left_anti").coalesce(1)
        fresh.write.parquet(self._pending())
        # as many names as this load's scan lists anyhow
        return sorted(r["path"] for r in self.spark.read.schema(SCHEMA).parquet(self._pending()).collect())

    def drop(self) -> None:
        """Nothing is to be loaded after all."""
        self._dir.delete(self._pending())

    def reject_path(self) -> str:
        """Where this load's refused rows are written ahead."""
        return f"{self._rejects}/{PENDING}{self.name}"

    def _pending(self, name: str | None = None) -> str:
        return f"{self._dir.path}/{PENDING}{name or self.name}"

    def moves(self, name: str | None = None) -> list[Move]:
        """What a publish commits besides the table."""
        name = name or self.name
        pairs = [
            (f"{self._rejects}/{PENDING}{name}", f"{self._rejects}/runDate={name[:10]}/load={name}"),
            (self._pending(name), f"{self._dir.path}/load={name}"),
        ]
        return [Move(s, t, *self._dir.content(s)) for s, t in pairs if self._dir.exists(s)]

    def by_version(self, version: str) -> None:
        """The publish is committed once a snapshot of the table names ``version``."""
        self._dir.write(f"{self._dir.path}/{VERSION_OF}{self.name}", version)

    def _settle(self) -> None:
        """Folders of loads that were cut off: those whose snapshot was committed are
        moved, others deleted."""
        held = Snapshots(self.spark, self._path).read()
        versions = set() if held is None else set(held.places.values())
        for pending in self._dir.names(f"{PENDING}*")[1]:
            name = pending.removeprefix(PENDING)
            noted = f"{self._dir.path}/{VERSION_OF}{name}"
            done = self._dir.exists(noted) and self._dir.read(noted) in versions
            for move in self.moves(name):
                if done:
                    self._dir.make(move.target.rpartition("/")[0])
                    self._dir.rename(move.source, move.target)
                else:
                    self._dir.delete(move.source)
        for noted in self._dir.names(f"{VERSION_OF}*")[1]:
            self._dir.delete(f"{self._dir.path}/{noted}")


def literal(path: str) -> str:
    """A path that Spark takes as it is, whatever glob characters it has."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)
