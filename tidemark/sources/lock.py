"""One writer per table: a lock file beside it, with an owner and a lease."""

from __future__ import annotations

import json
import threading
import time
from uuid import uuid4

from pyspark.sql import SparkSession

from tidemark.sources.filesystem import Directory

LEASE_SECONDS = 120.0

# locks that this process holds; one of its own that is not among them has a dead owner
_held: set[str] = set()


class TableLocked(RuntimeError):
    """Another load is writing the table."""


class WriterLock:
    """Held while a table is written: a second writer fails at once.

    The file is made by an exclusive create and names its owner and when its lease ends; a
    thread renews it. A lock whose lease has ended, or whose owner was this application
    and is no more, is taken over: it is renamed first, and only one writer can do that.
    ``check`` fails once the lock is someone else's, say after the process was
    suspended for longer than the lease. Clocks of writers may differ by less than a lease.
    """

    def __init__(self, spark: SparkSession, path: str, lease_seconds: float = LEASE_SECONDS):
        self._dir = Directory(spark, path)
        self.path = self._dir.sibling("__lock")
        self._lease = lease_seconds
        self.owner = f"{spark.sparkContext.applicationId}/{uuid4().hex}"
        self._app = spark.sparkContext.applicationId
        self._over = threading.Event()

    def _text(self) -> str:
        return json.dumps({"owner": self.owner, "until": time.time() + self._lease})

    def _found(self) -> dict:
        try:
            return json.loads(self._dir.read(self.path))
        except Exception:  # just being written, or just gone: nobody's yet
            return {"owner": "", "until": time.time() + self._lease}

    def __enter__(self) -> WriterLock:
        if not self._dir.create_new(self.path, self._text()):
            found = self._found()
            app, _, _ = found["owner"].partition("/")
            dead = found["until"] < time.time() or (app == self._app and found["owner"] not in _held)
            if not dead:
                raise TableLocked(f"{self._dir.path} is being written by {found['owner'] or 'another load'}")
            old = f"{self.path}-{uuid4().hex}"
            try:
                self._dir.rename(self.path, old)
            except Exception as lost:
                raise TableLocked(f"{self._dir.path}: another load took the lock over") from lost
            self._dir.delete(old)
            if not self._dir.create_new(self.path, self._text()):
                raise TableLocked(f"{self._dir.path}: another load took the lock over")
        _held.add(self.owner)
        self._renewer = threading.Thread(target=self._renew, daemon=True)
        self._renewer.start()
        return self

    def _renew(self) -> None:
        """In place: a lock file that is away for a moment is one that others can make."""
        while not self._over.wait(self._lease / 4):
            try:
                if self._found()["owner"] == self.owner:
                    self._dir.overwrite(self.path, self._text())
            except Exception:  # the store is away: the lease runs on, and check() will tell
                continue

    def check(self) -> None:
        """Fails unless the lock is still this writer's."""
        found = self._found()
        if found["owner"] not in ("", self.owner):
            raise TableLocked(f"{self._dir.path}: the lock went to {found['owner']}")

    def __exit__(self, *_exc) -> None:
        self._over.set()
        self._renewer.join()  # else a renewal on its way would make the file again
        _held.discard(self.owner)
        if self._found()["owner"] == self.owner:
            self._dir.delete(self.path)
