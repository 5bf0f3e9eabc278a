"""SimHash near-duplicates, compared on vertical bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from uuid import uuid4

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import col
from tidemark.llm.components import connected_components, star_edges
from tidemark.llm.shared import parted, ship, stage
from tidemark.operators import few_keys
from tidemark.operators.changes import rows_without

BITS = 64
CHUNK = 8192  # fingerprints of a bucket that are compared with each other in one piece
BUCKET = 64  # fingerprints that a bucket should hold on average
ITEMS = 1 << 15  # (fingerprint, word of lanes) pairs that are compared at a time
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of each bit over the XXH64 of all word shingles, repeats included.
    A-Z are lower-cased; words are parted by ASCII white space. A text of fewer words
    is one shingle, a text without words has fingerprint 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, last = b" ".join(words), max(len(words) - shingle, 0)
    tops = ends[min(shingle, len(words)) - 1 :].tolist()
    hash_of = xxhash.xxh64_intdigest
    count = np.zeros(BITS, np.int64)
    total = last + 1
    for low in range(0, total, 1 << 16):
        pairs = zip(starts[low : min(low + (1 << 16), total)].tolist(), tops[low : low + (1 << 16)], strict=True)
        hashes = np.array([hash_of(joined[a:b], seed) for a, b in pairs], "<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > total, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """``simhash`` of a text column as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle, seed) for t in texts], "u8").view("i8"))

    return of(text)


def bit_sliced_pairs(
    values: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with ``first[i] <= j < last[i]`` whose values differ in at most
    ``radius`` bits.

    The values are stored as 64 planes, plane s holding bit s of 64 values per word.
    One fingerprint meets a word of 64 others at a time: each plane's differences go
    into carry-save counters, and a word is given up once all of its lanes have
    counted beyond the radius.
    """
    m = len(values)
    bits = np.zeros((BITS, -(-m // 64) * 64), np.uint8)
    bits[:, :m] = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(m, 8), axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    low_word, words = first // 64, np.maximum(0, -(-last // 64) - first // 64) * (last > first)
    ends = np.cumsum(words)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    start = 0
    while start < m:
        # as many fingerprints as make ITEMS items, one at least
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + ITEMS, "right")))
        n = words[start:stop]
        query = np.repeat(np.arange(start, stop), n)
        word = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + low_word[query]
        for cut in range(0, len(query), 4 * ITEMS):
            found.append(_near(values, planes, query[cut : cut + 4 * ITEMS], word[cut : cut + 4 * ITEMS], first, last, radius))
        start = stop
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _near(values, planes, query, word, first, last, radius):
    low = np.clip(first[query] - 64 * word, 0, 63).astype(np.uint64)
    high = np.clip(64 * (word + 1) - last[query], 0, 63).astype(np.uint64)
    beyond = ~((FULL << low) & (FULL >> high))  # lanes that are out of range, or out of the radius
    counters = [np.zeros(len(query), np.uint64) for _ in range(radius.bit_length())]
    own = values[query]
    for s in range(BITS):
        carry = planes[s][word] ^ (np.uint64(0) - ((own >> np.uint64(s)) & np.uint64(1)))
        for n, c in enumerate(counters):
            counters[n], carry = c ^ carry, c & carry
        beyond |= carry
        if s % 8 == 7:
            alive = beyond != FULL
            if not alive.all():
                query, word, own, beyond = query[alive], word[alive], own[alive], beyond[alive]
                counters = [c[alive] for c in counters]
            if not len(query):
                break
    # a count that did not overflow may still exceed a radius that is not 2^k - 1
    equal = np.full(len(query), FULL)
    for n in range(len(counters) - 1, -1, -1):
        if radius >> n & 1:
            equal &= counters[n]
        else:
            beyond |= equal & counters[n]
            equal &= ~counters[n]
    lanes = np.unpackbits((~beyond).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    item, lane = np.nonzero(lanes)
    return query[item], word[item] * 64 + lane


def block_masks(count: int, radius: int) -> list[int]:
    """Masks of bits such that two values within ``radius`` agree on all bits of one
    mask at least: of b blocks, radius are left out in each way. b is the smallest for
    which ``count`` values leave BUCKET to a bucket; tables are more, buckets smaller,
    the more values there are."""
    for blocks in range(radius + 1, radius + 5):
        kept = blocks - radius
        if count <= BUCKET << (BITS * kept // blocks):
            break
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    one = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(one, kept)]


def fingerprint_links(fingerprints: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) that span the same components as all pairs of ``fingerprints``
    (column ``fp``, distinct longs) within ``radius`` bits of each other.

    Equal masked bits put fingerprints into a bucket. A bucket of more than CHUNK is
    cut into chunks, and each two chunks are a bucket of their own, so no task holds
    more than two. Buckets are compared on bit planes; of the links within a batch of
    buckets only a spanning star per component leaves the task. Nothing is left out.
    """
    ship(fingerprints.sparkSession)
    masks = block_masks(fingerprints.count(), radius)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(signed)])
    rows = fingerprints.select("fp", F.explode(keys).alias("_b")).select("fp", "_b.t", "_b.k")
    # at most rows / CHUNK of them: a table, so that Spark knows whether they are few
    large = stage(rows.groupBy("t", "k").count().where(F.col("count") > CHUNK))
    chunks = F.ceil(F.coalesce(F.col("count"), F.lit(1)) / F.lit(CHUNK)).cast("int")
    rows = rows.join(large, ["t", "k"], "left").withColumn("n", chunks)
    rows = rows.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    units = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda x: F.struct(F.least("c", x).alias("i"), F.greatest("c", x).alias("j")),
    )
    rows = rows.select("fp", "t", "k", "c", F.explode(units).alias("u")).select("fp", "t", "k", "c", "u.i", "u.j")
    unit = ["t", "k", "i", "j"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            # the last unit may go on in the next batch
            last = (rest[unit] != rest[unit].iloc[-1]).any(axis=1).to_numpy().nonzero()[0]
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield _links(rest.iloc[:cut], unit, radius)
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield _links(rest, unit, radius)

    spread = rows.repartition(*unit).sortWithinPartitions(*unit, "c")
    return spread.mapInPandas(compare, "a long, b long").distinct()


def _links(rows: pd.DataFrame, unit: list[str], radius: int) -> pd.DataFrame:
    fps, m = rows["fp"].to_numpy(), len(rows)
    # rows come by unit, then by chunk
    begins = np.flatnonzero(np.r_[True, (rows[unit].to_numpy()[1:] != rows[unit].to_numpy()[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[begins, m])
    ends = np.repeat(begins + sizes, sizes)
    chunk, low, high = (rows[c].to_numpy() for c in "cij")
    # within a chunk each row meets those after it, else the rows of the other chunk
    firsts = np.add.reduceat((chunk == low).astype(np.int64), begins) if m else sizes
    border = np.repeat(begins + firsts, sizes)
    first = np.where(low == high, np.arange(m) + 1, border)
    last = np.where((low == high) | (chunk == low), ends, first)
    a, b = bit_sliced_pairs(fps.view(np.uint64), first, last, radius)
    label = star_edges(a, b, m)
    moved = np.flatnonzero(label != np.arange(m))
    return pd.DataFrame({"a": fps[moved], "b": fps[label[moved]]}).drop_duplicates()


def simhash_groups(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id, root): near-duplicate groups of whole ``docs`` texts;
    ``root`` is a fingerprint that names the group.

    Documents with equal fingerprints are one node, so copies are never paired. Nodes
    within ``radius`` bits are linked, whatever their number, and ``component_id`` is
    the smallest doc_id that links reach. Texts without words (NULL too) have
    fingerprint 0 and are linked like any other. Repeated rows give repeated rows; a
    NULL doc_id is in a group but never its smallest, and a group of NULLs alone has a
    NULL component_id. Other columns of ``docs`` are not read. An empty table gives an
    empty result.
    """
    ship(docs.sparkSession)
    rows = stage(docs.select(F.col("doc_id").cast("long"), fingerprint(F.col("text"), shingle, seed).alias("fp")))
    nodes = _rooted(stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low"))), radius)
    lowest = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stage(nodes.join(lowest, "root").select("fp", "component_id", "root"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes`` (fp, distinct, and others) with the fingerprint that names their group."""
    found = connected_components(fingerprint_links(nodes.select("fp"), radius))
    return nodes.join(found, nodes["fp"] == found["node"], "left").withColumn("root", F.coalesce("component", "fp"))


def keep_one(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest doc_id
    (NULL last), and of rows that share it, that of the smallest SHA-256 over the row.

    Which rows go is settled on digests alone: per fingerprint, then per group, the
    smallest is kept. Where the digests of the rows that go are too many to be broadcast,
    the texts of those that a bit map takes for them move, once. Rows that are equal in all columns are one and stay once; NULL
    text is a text without words; an empty table gives an empty one. Columns of any
    name pass through.
    """
    ship(docs.sparkSession)
    row = f"row-{uuid4().hex}"
    marked = docs.withColumn(row, F.sha2(F.to_json(F.struct(*[col(c) for c in docs.columns])), 256))
    rows = marked.select(
        F.col(row).alias("row"),
        F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.col(row).alias("row")).alias("rank"),
        fingerprint(F.col("text"), shingle, seed).alias("fp"),
    )
    rows = stage(rows)
    nodes = _rooted(stage(rows.groupBy("fp").agg(F.min("rank").alias("best"))), radius)
    kept = stage(nodes.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row)))
    counted = stage(rows.groupBy(F.col("row").alias(row)).count())
    repeated = counted.where("count > 1").select(row)
    gone = stage(counted.select(row).join(kept, row, "left_anti").union(repeated).distinct())
    few = few_keys(gone, [row])
    if few is not None:
        whole = marked.join(few, row, "left_anti")
    else:
        maybe, sure = parted(marked, gone, row)
        whole = sure.unionByName(rows_without(maybe, gone, [row]))
    again = stage(repeated.join(kept, row, "left_semi"))
    if again.count():
        whole = whole.unionByName(marked.join(again, row, "left_semi").dropDuplicates([row]))
    return whole.select(*[col(c) for c in docs.columns])
