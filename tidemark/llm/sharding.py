"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import ship, shuffle_partitions, stage


CHUNK = 100_000  # groups that are held and differenced at once


def differencing(vectors: Sequence[tuple[int, ...]], shards: int) -> list[list[int]]:
    """Merge partial partitions, each given as its part sums in ascending order.

    Always the two with the largest spread are combined, the largest part of one with
    the smallest of the other. Returns, per input, which shard each of its parts went
    to; the shards come out in ascending order of their sums.
    """
    zero = (0,) * shards
    heap = [(min(v) - max(v), n, v) for n, v in enumerate(vectors)]
    heapq.heapify(heap)
    merges = []  # (left, right, order of the combined parts before they were sorted)
    n = len(heap)
    while len(heap) > 1:
        _, left, a = heapq.heappop(heap)
        _, right, b = heapq.heappop(heap)
        sums = list(map(int.__add__, a, b[::-1]))
        order = sorted(range(shards), key=sums.__getitem__)
        v = tuple(sums[i] for i in order)
        merges.append((left, right, order))
        heapq.heappush(heap, (v[0] - v[-1], n, v))
        n += 1
    places = {n - 1: list(range(shards))} if vectors else {}
    for m in range(len(merges) - 1, -1, -1):
        left, right, order = merges[m]
        own = places.pop(len(vectors) + m)
        part = [0] * shards
        for place, i in zip(own, order, strict=True):
            part[i] = place
        places[left], places[right] = part, part[::-1]
    return [places[i] if i in places else list(zero) for i in range(len(vectors))]


def _merged(vectors: dict[int, list[int]], shards: int) -> Iterator[tuple[int, int, int]]:
    """Merges partial partitions, given by the sums of their parts in any order: (name,
    part, place of that part in the whole)."""
    names = sorted(vectors)
    order = {n: sorted(range(shards), key=vectors[n].__getitem__) for n in names}
    places = differencing([tuple(vectors[n][i] for i in order[n]) for n in names], shards)
    for n, own in zip(names, places, strict=True):
        for part, place in zip(order[n], own, strict=True):
            yield n, part, place


def _sums(rows: Iterable[tuple[int, int, int]], shards: int) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for name, part, n in rows:
        out.setdefault(name, [0] * shards)[part] += n
    return out


def shard_groups(groups: DataFrame, shards: int = 16, chunk: int = CHUNK) -> DataFrame:
    """``groups`` (one row per group, with ``bytes``) with ``shard``: sums of bytes
    near equal, no group divided.

    Differencing runs three times. Each task merges its own groups, some ``chunk`` of
    them at a time, into partial partitions of ``shards`` parts; those of a task, ``shards``
    numbers per chunk, are merged by the same rule, and those of all tasks likewise.
    The first result is a table, so that the numbers of tasks and chunks it holds
    cannot change. A task holds a chunk, however many groups it has. NULL bytes
    count as 0; an empty table gives none.
    """
    spark, columns = groups.sparkSession, groups.columns
    ship(spark)

    def in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, rows in enumerate(_chunks(batches, chunk)):
            sizes = rows["bytes"].fillna(0).astype("int64").tolist()
            places = differencing([(0,) * (shards - 1) + (s,) for s in sizes], shards)
            rows["_task"] = TaskContext.get().partitionId()
            rows["_chunk"] = number
            rows["_part"] = [p[-1] for p in places]
            yield rows

    def of_task(rows: pd.DataFrame) -> pd.DataFrame:
        sums = _sums(zip(rows["_chunk"], rows["_part"], rows["n"]), shards)
        merged = pd.DataFrame(_merged(sums, shards), columns=["_chunk", "_part", "_place"])
        merged["n"] = [sums[c][p] for c, p in zip(merged["_chunk"], merged["_part"])]
        return merged.assign(_task=rows["_task"].iloc[0])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in groups.schema)
    parts = stage(groups.mapInPandas(in_task, f"{schema}, _task int, _chunk int, _part int"))
    sums = parts.groupBy("_task", "_chunk", "_part").agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("n"))
    # shards numbers per chunk, whatever the number of groups
    merged = stage(sums.groupBy("_task").applyInPandas(of_task, "_chunk int, _part int, _place int, n long, _task int"))
    # shards numbers per task: bounded by the number of tasks
    of_tasks = merged.groupBy("_task", "_place").agg(F.sum("n").alias("n")).collect()
    names = spark.createDataFrame([*_merged(_sums(of_tasks, shards), shards)], "_task int, _place int, shard int")
    places = merged.join(F.broadcast(names), ["_task", "_place"]).select("_task", "_chunk", "_part", "shard")
    return parts.join(places, ["_task", "_chunk", "_part"]).select(*columns, "shard")


def _chunks(batches: Iterator[pd.DataFrame], chunk: int) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for batch in batches:
        for low in range(0, len(batch), chunk):
            held.append(batch.iloc[low : low + chunk])
            if sum(map(len, held)) >= chunk:
                yield pd.concat(held, ignore_index=True)
                held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    ``size`` is the UTF-8 bytes of the text and one more. Documents with equal texts
    form a group, which no shard divides; NULL text counts as the empty text. ``law``
    is ``bytes``: the shards' sizes are near equal, so one group larger than a shard's
    share stays in one shard. ``slot`` counts a shard's documents from 0 without gaps.
    Growing is for laws by key, so ``grown_shard`` is NULL. Repeated rows are
    documents of their own. Other columns of ``docs`` are not read. Texts stay where
    they are; digests of 16 bytes move.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("_group"),
        )
    )
    groups = rows.groupBy("_group").agg(F.sum("size").alias("bytes"))
    placed = stage(shard_groups(groups, shards).select("_group", "shard"))
    return with_slots(rows.join(placed, "_group").drop("_group")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_slots(rows: DataFrame) -> DataFrame:
    """``slot``: gapless numbers from 0 within each ``shard``, without bringing a shard
    to one task. Rows are numbered within pieces of a shard, and the pieces' counts
    say where each begins."""
    pieces = shuffle_partitions(rows.sparkSession)
    rows = stage(rows.withColumn("_piece", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(pieces)).cast("int")))
    counts = rows.groupBy("shard", "_piece").count()
    upto = Window.partitionBy("shard").orderBy("_piece")
    # at most shards x pieces rows
    begins = stage(counts.select("shard", "_piece", (F.sum("count").over(upto) - F.col("count")).alias("_begin")))
    within = Window.partitionBy("shard", "_piece").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("_n", F.row_number().over(within) - 1)
    return (
        numbered.join(begins, ["shard", "_piece"])
        .withColumn("slot", (F.col("_begin") + F.col("_n")).cast("long"))
        .drop("_piece", "_begin", "_n")
    )
