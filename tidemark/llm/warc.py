"""WARC archives: written one gzip member per record, read back by byte ranges."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import ship, shuffle_partitions, stage
from tidemark.sources.filesystem import Directory

MAGIC = b"\x1f\x8b\x08"  # fixed: gzip's signature and its one method
BLOCK = 1 << 20
SIGNATURE = b"WARC/1."  # fixed: how a record begins
HEADER_STEP = 1 << 16  # bytes that are inflated at a time while a header goes on
SMALLEST_REVISIT = 100  # bytes of payload from which equal ones are written once
DATE = "2024-01-01T00:00:00Z"

WRITTEN = "file string, records long"
RECORD = (
    "file string, start long, record_id string, record_type string, target_uri string, refers_to string,"
    " payload_digest string, payload_bytes long, payload binary"
)


def with_revisits(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """``pages`` with ``digest``, ``record_type`` and ``refers_to``: of equal payloads of
    100 bytes or more the smallest ``key`` is the response and the others revisit it.

    Only keys and digests are grouped; the classes with copies are joined back. NULL
    payload is empty. A NULL key is never the smallest: such rows revisit one that has
    a key, or are responses where none has. Rows that repeat the smallest key are all
    responses."""
    head = f"head-{uuid4().hex}"
    pages = pages.withColumn("digest", F.sha2(F.coalesce(F.col(payload), F.lit("")), 256))
    heads = (
        pages.where(F.octet_length(payload) >= SMALLEST_REVISIT)
        .groupBy("digest")
        .agg(F.min(key).alias(head), F.count("*").alias("_n"))
        .where("_n > 1")
        .select("digest", head)
    )
    pages = pages.join(stage(heads), "digest", "left")
    revisits = F.col(head).isNotNull() & ~F.col(key).eqNullSafe(F.col(head))
    return pages.withColumns(
        {
            "record_type": F.when(revisits, "revisit").otherwise("response"),
            "refers_to": F.when(revisits, F.col(head)),
        }
    ).drop(head)


def urn(key: str | None) -> str:
    return f"<urn:page:{key or ''}>"


def record(page) -> bytes:
    """One record, its block an HTTP response; a revisit has only its head."""
    payload = (page.payload or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {page.record_type}",
        f"WARC-Record-ID: {urn(page.key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((page.uri or '').split())}",
        f"WARC-Payload-Digest: sha256:{page.digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page.record_type == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {urn(page.refers_to)}",
        ]
        payload = b""
    lines.append(f"Content-Length: {len(head) + len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + head + payload + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Writes ``pages`` (key, uri, payload, digest, record_type, refers_to) to
    ``folder``, an archive per task, and returns its files with their record counts.

    Each record is a gzip member. A task writes under a name of its own and renames at
    the end, so a task that is run again replaces its file, and one that was cut off
    leaves nothing that a reader takes for an archive. Without pages the folder is made
    and stays empty. One record is in memory at a time, besides the batch. ``folder`` is any store that pyarrow's file systems open.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = pafs.FileSystem.from_uri(folder)
        name = f"{path}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        unfinished, count, out = f"{name}.{uuid4().hex}.tmp", 0, None
        for batch in batches:
            for page in batch.itertuples(index=False):
                if out is None:
                    store.create_dir(path, recursive=True)
                    out = store.open_output_stream(unfinished)
                packer = zlib.compressobj(level, wbits=31)
                out.write(packer.compress(record(page)) + packer.flush())
                count += 1
        if out is not None:
            out.close()
            store.move(unfinished, name)
            yield pd.DataFrame({"file": [name], "records": [count]})

    ship(pages.sparkSession)
    Directory(pages.sparkSession, folder).make()
    columns = ("key", "uri", "payload", "digest", "record_type", "refers_to")
    return stage(pages.select(*[F.col(c).cast("string") for c in columns]).mapInPandas(write, WRITTEN))


class Range:
    """Reads the records of an archive whose members start in [start, end)."""

    def __init__(self, store, path: str, start: int, end: int):
        self._file = store.open_input_file(path)
        self._size = self._file.size()
        self._start, self._end = start, min(end, self._size)

    def __enter__(self) -> Range:
        return self

    def __exit__(self, *_exc) -> None:
        self._file.close()

    def _at(self, position: int, n: int) -> bytes:
        return self._file.read_at(max(0, min(n, self._size - position)), position)

    def records(self) -> Iterator[tuple[int, bytes]]:
        """(start, record) of each valid member. Bytes that look like a member but do
        not inflate to a WARC header are passed over."""
        at, block, base = self._start, b"", self._start
        while at < self._end:
            found = block.find(MAGIC, at - base)
            if found < 0:
                # the magic may straddle two blocks
                at = max(at, base + len(block) - len(MAGIC) + 1)
                if base + len(block) >= min(self._end + len(MAGIC), self._size):
                    return
                block, base = self._at(at, BLOCK), at
                continue
            at = base + found
            if at >= self._end:
                return
            member = self._member(at)
            if member is None:
                at += 1
                continue
            body, after = member
            yield at, body
            at = after
            if at > base + len(block):
                block, base = b"", at

    def _member(self, start: int) -> tuple[bytes, int] | None:
        """The record that starts here and the position after it; None if none does."""
        inflate, out, at = zlib.decompressobj(31), bytearray(), start
        proved = False
        try:
            while not inflate.eof:
                block = self._at(at, BLOCK if proved else HEADER_STEP)
                if not block:
                    return None
                at += len(block)
                if proved:
                    out += inflate.decompress(block)
                while not proved and block:
                    searched = max(0, len(out) - 3)
                    out += inflate.decompress(block, HEADER_STEP)
                    block = inflate.unconsumed_tail
                    if not out[: len(SIGNATURE)] == SIGNATURE[: len(out)]:
                        return None
                    if out.find(b"\r\n\r\n", searched) >= 0:
                        proved = True
                        out += inflate.decompress(block)
        except zlib.error:
            return None
        return (bytes(out), at - len(inflate.unused_data)) if proved else None


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parsed(file: str, start: int, body: bytes, payloads: bool) -> tuple:
    """A row of RECORD. The digest of a response is that of the payload found; a
    revisit names its payload's digest and, in the HTTP head, its length."""
    head, _, rest = body.partition(b"\r\n\r\n")
    fields = fields_of(head)
    block = rest[: int(fields["content-length"])]
    http = block.partition(b"\r\n\r\n")[0]
    kind = fields.get("warc-type")
    if kind == "response":
        payload = block[len(http) + 4 :]
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    else:
        payload = None
        digest = fields.get("warc-payload-digest", "").rpartition(":")[2]
        size = int(fields_of(http).get("content-length", 0))
    return (
        file,
        start,
        fields.get("warc-record-id"),
        kind,
        fields.get("warc-target-uri"),
        fields.get("warc-refers-to"),
        digest,
        size,
        payload if payloads else None,
    )


def read_warc(spark: SparkSession, folder: str, split_bytes: int = 32 << 20, payloads: bool = True) -> DataFrame:
    """The records of all ``*.warc.gz`` in ``folder``, one row each (RECORD).

    Archives are split by bytes, not by file: a task looks for gzip's magic in its
    range, takes a place for a member if a WARC header comes out of it, and owns the
    records that start inside, reading on past its end to finish the last. So each
    record is read once, whatever ``split_bytes``. A task holds one record at a time
    and ROWS of them. Members that are damaged, or no WARC, are passed over; a folder
    without archives gives no rows.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = files.where("length > 0").select("path", F.explode(starts).alias("start"))
    ranges = ranges.repartition(shuffle_partitions(spark), "path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"], strict=True):
                store, name = pafs.FileSystem.from_uri(path)
                rows, size = [], 0
                with Range(store, name, int(start), int(start) + split_bytes) as part:
                    for at, body in part.records():
                        rows.append(parsed(path, at, body, payloads))
                        size += len(body)
                        if len(rows) >= ROWS or size >= 16 * BLOCK:
                            yield pd.DataFrame(rows, columns=NAMES)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=NAMES)

    return ranges.mapInPandas(read, RECORD)


ROWS = 2000
NAMES = [c.split()[0] for c in RECORD.split(",")]
