"""Directory operations through Hadoop's FileSystem, for whatever store holds the table."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Content(NamedTuple):
    """What a directory holds, subdirectories included."""

    files: int
    size: int


class Directory:
    """Names and moves under one Hadoop file system. Metadata only, no data passes."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        raw = self._hadoop.Path(path)
        self._fs = raw.getFileSystem(conf)
        self.path = self._fs.makeQualified(raw).toString()

    def _of(self, path: str):
        return self._hadoop.Path(path)

    def sibling(self, suffix: str) -> str:
        """A name next to this directory that Spark's file listing ignores."""
        own = self._of(self.path)
        return f"{own.getParent().toString().rstrip('/')}/_{own.getName()}{suffix}"

    def exists(self, path: str | None = None) -> bool:
        return self._fs.exists(self._of(path or self.path))

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._of(source), self._of(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, path: str | None = None) -> None:
        self._fs.delete(self._of(path or self.path), True)

    def delete_on_exit(self) -> None:
        """Have Hadoop delete the directory when the driver's JVM ends."""
        self._fs.deleteOnExit(self._of(self.path))

    def make(self, path: str | None = None) -> None:
        self._fs.mkdirs(self._of(path or self.path))

    def content(self, path: str | None = None) -> Content:
        """One call, however many files there are; nothing where there is no directory."""
        if not self.exists(path):
            return Content(0, 0)
        found = self._fs.getContentSummary(self._of(path or self.path))
        return Content(found.getFileCount(), found.getLength())

    def names(self, pattern: str, most: int | None = None, folder: str | None = None) -> tuple[int, list[str]]:
        """How many entries of the directory, or of another ``folder``, match a glob, and
        ``most`` of their names."""
        found = self._fs.globStatus(self._of(f"{folder or self.path}/{pattern}")) or []
        count = len(found)
        wanted = range(count if most is None else min(count, most))
        return count, [found[i].getPath().getName() for i in wanted]

    def read(self, path: str) -> str:
        stream = self._fs.open(self._of(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """A small file, unless there is one of that name already."""
        try:
            stream = self._fs.create(self._of(path), False)
        except Py4JJavaError:
            if self.exists(path):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def overwrite(self, path: str, text: str) -> None:
        """A small file's new text in its place: it is there throughout, if not whole."""
        stream = self._fs.create(self._of(path), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def write(self, path: str, text: str) -> None:
        """A small file, whole or not at all."""
        unfinished = f"{path}_unfinished"
        self.overwrite(unfinished, text)
        self.delete(path)
        self.rename(unfinished, path)
