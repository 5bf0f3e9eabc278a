"""Phrases whose words come together more often than their parts would say, counted in
tiles of frequency-ranked ids."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import col
from tidemark.llm.shared import ship, stage
from tidemark.operators import fits_by_rows, salted_left_join

BITS = 9  # of the ids along the side of a tile
EDGE = 1 << BITS
DENSE = 1 << 10  # pairs of a buffer that make a tile dense
MOST_DENSE = 16  # dense tiles that a task holds, 2 MB each
BUFFER = 1 << 18  # pairs that a task gathers before it counts them
SPARSE = 1 << 19  # counted sparse pairs from which a task adds them up, and hands them on if half stay
WORDS = 1 << 18  # distinct words that a task counts before it hands them on
ROW = 1 << 16  # words of an encoded row, unless one document has more; rows of a batch
BLOCK_BYTES = 64 << 20  # of a lookup that is sent to the workers at a time
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20  # of rows that a task sends to Python at a time
MOST_UNITS = 1 << 31  # so that a unit and a word make one 64-bit key
STOP = b"."  # stands for any end of a piece, since no word holds one
# fixed: A-Z become lower case, ends of pieces STOP, and tabs spaces
BYTES = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b".........." + b" ")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, rows go to Python by bytes too, not by their number alone: texts and
    encoded rows are long, and an executor holds a batch several times."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in lower case, with STOP between its pieces."""
    return (text or "").encode().translate(BYTES).replace(STOP, b" . ").split()


def _tiled(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of ids of 31 bits as keys in the order of their tiles: the tile, then the
    place in it."""
    return (left >> BITS) << (31 + BITS) | (right >> BITS) << (2 * BITS) | (left & (EDGE - 1)) << BITS | right & (EDGE - 1)


def _pairs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = keys >> (31 + BITS) << BITS | keys >> BITS & (EDGE - 1)
    return left, (keys >> (2 * BITS) & ((1 << (31 - BITS)) - 1)) << BITS | keys & (EDGE - 1)


def _begins(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


class PairTiles:
    """Counts of pairs (left, right) of ids that are ranked by frequency, in tiles of EDGE
    by EDGE. A tile that many pairs fall into is counted by its direct addresses; the
    pairs of the others are kept as sorted keys with counts. It holds one buffer, the dense
    tiles and SPARSE and a buffer's worth of counted pairs, and gives parts of ROW pairs."""

    def __init__(self):
        self._buffer = np.empty(BUFFER, np.int64)
        self._held = 0
        self._dense: dict[int, np.ndarray] = {}
        self._runs: list[tuple[np.ndarray, np.ndarray]] = []
        self._sparse = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Takes pairs; gives counted ones when it holds too many."""
        keys = _tiled(left, right)
        while len(keys):
            part, keys = np.split(keys, [BUFFER - self._held])
            self._buffer[self._held : self._held + len(part)] = part
            self._held += len(part)
            if self._held == BUFFER:
                self._count()
                if self._sparse > SPARSE:
                    self._add_up()
                    if self._sparse > SPARSE // 2:
                        yield from self._handed_on()

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if self._held:
            self._count()
        if self._sparse:
            self._add_up()
            yield from self._handed_on()
        while self._dense:
            tile, counts = self._dense.popitem()
            at = np.flatnonzero(counts)
            yield from self._parts(tile << (2 * BITS) | at, counts[at])

    def _count(self) -> None:
        keys = self._buffer[: self._held]
        self._held = 0
        keys.sort()
        at = _begins(keys)
        keys, counts = keys[at], np.diff(at, append=len(keys))
        tile = keys >> (2 * BITS)
        begins = _begins(tile)
        sizes, ends = np.add.reduceat(counts, begins), np.append(begins[1:], len(keys))
        large = np.flatnonzero(sizes >= DENSE)
        sparse = np.ones(len(keys), bool)
        for n in large[np.argsort(-sizes[large], kind="stable")].tolist():
            name, part = int(tile[begins[n]]), slice(begins[n], ends[n])
            if name not in self._dense:
                if len(self._dense) >= MOST_DENSE:
                    continue
                self._dense[name] = np.zeros(EDGE * EDGE, np.int64)
            self._dense[name][keys[part] & (EDGE * EDGE - 1)] += counts[part]
            sparse[part] = False
        self._runs.append((keys[sparse], counts[sparse]))
        self._sparse += len(self._runs[-1][0])

    def _add_up(self) -> None:
        keys, counts = (np.concatenate([r[n] for r in self._runs]) for n in (0, 1))
        self._runs = []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begins = _begins(keys)
        self._runs = [(keys[begins], np.add.reduceat(counts, begins))]
        self._sparse = len(begins)

    def _handed_on(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        runs, self._runs, self._sparse = self._runs, [], 0
        for keys, counts in runs:
            yield from self._parts(keys, counts)

    def _parts(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for low in range(0, len(keys), ROW):
            yield *_pairs_of(keys[low : low + ROW]), counts[low : low + ROW]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of a task, and per language a row without word for all of them."""
    counts: dict[str, Counter] = {}
    totals: Counter = Counter()

    def handed_on() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            words = list(own)
            for low in range(0, len(words), ROW):
                part = words[low : low + ROW]
                yield _rows(pa.array([lang] * len(part)), pa.array(part, pa.binary()), pa.array([own[w] for w in part], pa.int64()))
        counts.clear()

    names = ["lang", "word", "n"]
    _rows = lambda *columns: pa.RecordBatch.from_arrays(list(columns), names)
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            words = words_of(text.as_py())
            own = counts.setdefault(lang, Counter())
            own.update(words)
            totals[lang] += len(words) - own.pop(STOP, 0)
            if sum(map(len, counts.values())) > WORDS:
                yield from handed_on()
    yield from handed_on()
    yield _rows(pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.binary()), pa.array(list(totals.values()), pa.int64()))


def _ranked(rows: DataFrame, name: str, *ties: str) -> DataFrame:
    """``rows`` with the place of each in the order of falling ``n`` (then of ``ties``). They
    are sorted over all tasks; the driver sees the size of each task's part."""
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    rows = stage(rows.orderBy(F.desc("n"), *ties).withColumn("_at", F.monotonically_increasing_id()))
    sizes = dict(rows.groupBy(part).count().collect())
    if sum(sizes.values()) >= MOST_UNITS:
        raise ValueError("more frequent phrases than a 64-bit key can name")
    before, starts = 0, []
    for n in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(n, 0)
    first = F.element_at(F.lit(np.array(starts or [0], np.int64)), part.cast("int") + 1)
    return rows.withColumn(name, first + at).drop("_at")


def _blocks(rows: DataFrame, key: str, size) -> list[DataFrame]:
    """``rows`` in as many parts, by ``key``, as make each small enough to be sent to all
    workers; rows of one key stay together."""
    block_bytes = BLOCK_BYTES
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    count = max(1, -(-total // block_bytes))
    while count > 1:
        largest = rows.groupBy(F.pmod(key, F.lit(count))).agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0]
        if largest <= 2 * block_bytes or count >= total:
            break
        count *= 2
    return [rows] if count == 1 else [rows.where(F.pmod(key, F.lit(count)) == b) for b in range(count)]


def _encoded(texts: DataFrame, words: DataFrame) -> DataFrame:
    """The texts as ids of frequent words (little-endian 32 bits), -1 for any other word and
    between pieces and documents. Several documents make a row."""
    context = texts.sparkSession.sparkContext
    blocks = _blocks(words, "id", F.octet_length("word") + 64)
    rows = texts
    for n, block in enumerate(blocks):
        sent = context.broadcast(block.select("lang", "word", "id").toArrow().combine_chunks())
        last = n == len(blocks) - 1
        rows = rows.mapInArrow(_encoder(sent, n > 0, last), "ids binary" if last else "lang string, text string, ids binary")
        rows = stage(rows)
    return rows


def _encoder(sent, again: bool, last: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[bytes, int]] = {}
        for part in sent.value.to_batches(ROW):
            for lang, word, n in zip(*(part[c].to_pylist() for c in ("lang", "word", "id")), strict=True):
                known.setdefault(lang, {})[word] = n
        rows, size = [], 0
        end = np.array([-1], "<i4")
        for batch in batches:
            out = []
            for n, (lang, text) in enumerate(zip(batch["lang"].to_pylist(), batch["text"], strict=True)):
                words = words_of(text.as_py())
                ids = np.fromiter(map(known.get(lang, {}).get, words, repeat(-1)), "<i4", len(words))
                if again:
                    before = np.frombuffer(batch["ids"][n].as_py(), "<i4")
                    ids = np.where(before >= 0, before, ids)
                if not last:
                    out.append(ids.tobytes())
                    continue
                rows += [ids, end]
                size += len(ids) + 1
                if size >= ROW:
                    yield _one_row(rows)
                    rows, size = [], 0
            if not last:
                columns = [batch["lang"], batch["text"], pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "text", "ids"])
        if rows:
            yield _one_row(rows)

    return encode


def _one_row(rows: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.concatenate(rows).tobytes()], pa.binary())], ["ids"])


def _longer(encoded: DataFrame, lookups: list[DataFrame], least: int) -> DataFrame:
    """(left, word, n): frequent phrases of one word more. ``left`` is the id of the phrase
    without its last word: of the last of ``lookups`` (left, word, first, id), which
    begin with the pairs; without any, of the word before."""
    context = encoded.sparkSession.sparkContext
    if not lookups:
        sets = [[]]
    else:
        # phrases that begin with one pair go together, so a block knows all that begin in it
        joint = lookups[0].select(F.col("first"), F.lit(24).alias("size"))
        for rows in lookups[1:]:
            joint = joint.unionAll(rows.select("first", F.lit(24)))
        count = len(_blocks(joint, "first", F.col("size")))
        sets = [[rows.where(F.pmod("first", F.lit(count)) == b) for rows in lookups] for b in range(count)]
    found = None
    for chosen in sets:
        tables = []
        for rows in chosen:
            keys = rows.select((F.col("left") * (1 << 31) + F.col("word")).alias("key"), "id").toArrow()
            key, own = (keys[c].to_numpy().astype(np.int64) for c in ("key", "id"))
            order = np.argsort(key)
            tables.append((key[order], own[order]))
        sent = context.broadcast(tables)
        counted = encoded.mapInArrow(_counter(sent, len(sets) == 1), "left long, word long, n long")
        found = counted if found is None else found.unionAll(counted)
    # the tasks have added up what they can, so sums are taken behind the shuffle alone
    found = found.repartition("left", "word").groupBy("left", "word").agg(F.sum("n").alias("n"))
    return stage(found.where(F.col("n") >= least))


def _counter(sent, whole: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = PairTiles()
        for batch in batches:
            for words in _stretches(batch["ids"], len(sent.value) + 1):
                unit = words
                for keys, ids in sent.value:
                    left, right = unit[:-1], words[len(words) - len(unit) + 1 :]
                    key = np.where((left >= 0) & (right >= 0), left << 31 | right, -1)
                    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                    unit = np.where(keys[at] == key, ids[at], -1) if len(keys) else np.full(len(key), -1)
                left, right = unit[:-1], words[len(words) - len(unit) + 1 :]
                good = (left >= 0) & (right >= 0)
                if whole and sent.value:  # what is not frequent itself is in no frequent phrase
                    good &= unit[1:] >= 0
                yield from map(_pairs, tiles.add(left[good], right[good]))
        yield from map(_pairs, tiles.rest())

    return count


def _stretches(rows: pa.Array, more: int) -> Iterator[np.ndarray]:
    """The ids of encoded rows by ROW, each stretch with as many as ``more`` that follow it."""
    for row in rows:
        ids = np.frombuffer(row.as_buffer(), "<i4")
        for low in range(0, len(ids), ROW):
            yield ids[low : low + ROW + more].astype(np.int64)


def _pairs(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in found], ["left", "word", "n"])


def _with(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key``; a key that many
    rows have is spread over tasks."""
    if fits_by_rows(table):
        return rows.join(F.broadcast(table), key)
    return salted_left_join(rows, table, [key])


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, contained: tuple[int, int] = (80, 100)) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``longest`` (4 at most) words by score: lang,
    rank, phrase, a, l, r, n, score.

    Texts in lower case (A-Z) are split at punctuation and line ends into pieces, and at
    spaces and tabs into words; n counts a language's words, a phrase's occurrences within
    pieces. A phrase that occurs ``least`` times is a candidate; cut after its first k words
    into parts that occur l and r times, its score is floor(2000000 a / (l + r)) at the cut
    where that is lowest (then k). Candidates within a longer one that has at least 80 in
    100 of their occurrences go.

    Frequent words are ranked over all languages and texts encoded once. Pairs of ids are
    counted in tiles by each task and added up over tasks; frequent pairs are ranked anew
    and stand for one id when they are paired with the next word, and so on. Lookups are
    sent to the workers in blocks of bounded size, a pass for each; all is counted,
    whatever their number. Arithmetic is in whole numbers, products in decimals.

    NULL text is empty, a NULL lang is ``und`` (as is that lang); repeated rows count as
    often as they are there; other columns and doc_ids are not read; an empty table gives
    an empty one.
    """
    if not 2 <= longest <= 4:
        raise ValueError("longest is 2, 3 or 4")
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string"))
    levels: list[DataFrame] = []
    with _small_batches(docs.sparkSession):
        counts = texts.mapInArrow(_counted, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
        counts = stage(counts.where(F.col("word").isNull() | (F.col("n") >= least)))
        words = stage(_ranked(counts.where("word is not null"), "id", "lang", "word"))
        encoded = _encoded(texts, words)

        for size in range(2, longest + 1):
            rows = _ranked(_longer(encoded, levels, least), "id", "left", "word")
            first = F.col("id") if size == 2 else F.col("left")  # pairs' ids: of themselves, of a triple's left
            if size == 2:
                spelt = F.array("left", "word")
                rows = rows.withColumn("ids", spelt)
            else:
                before = levels[-1].select(F.col("id").alias("left"), F.col("ids").alias("_ids"))
                rows = _with(rows, before, "left").withColumn("ids", F.array_append("_ids", F.col("word"))).drop("_ids")
            levels.append(stage(rows.withColumn("first", first)))

    candidates = levels[0].select("ids", "n")
    for rows in levels[1:]:
        candidates = candidates.unionAll(rows.select("ids", "n"))
    candidates = stage(candidates.withColumnRenamed("n", "a"))
    return _top(candidates, words, counts.where("word is null"), top, contained)


def _top(candidates: DataFrame, words: DataFrame, totals: DataFrame, top: int, contained: tuple[int, int]) -> DataFrame:
    big = lambda c: F.col(c).cast("decimal(19,0)")
    size = F.size("ids")
    # those that a longer candidate holds most of
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2))),
            lambda k: F.transform(F.sequence(F.lit(1), F.greatest(size - k + 1, F.lit(1))), lambda at: F.slice("ids", at, k)),
        )
    )
    held = candidates.where(size > 2).select(F.explode(inner).alias("ids"), F.col("a").alias("_a"))
    held = held.groupBy("ids").agg(F.max("_a").alias("_a"))
    left = candidates.join(held, "ids", "left")
    left = stage(left.where(F.col("_a").isNull() | (big("_a") * contained[1] < big("a") * contained[0])).select("ids", "a"))

    known = stage(words.select(F.array("id").alias("ids"), "n").unionAll(candidates.select("ids", F.col("a").alias("n"))))
    cuts = left.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("ids", 1, F.col("k")), "tail": F.slice("ids", F.col("k") + 1, size)})
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = _with(cuts, known.select(F.col("ids").alias(part), F.col("n").alias(name)), part)
    score = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + r) as long)")
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    best = stage(best.select("ids", "a", "cut.l", "cut.r", "cut.score"))

    spelt = best.select("ids", F.posexplode("ids").alias("at", "id"))
    spelt = _with(spelt, words.select("id", "lang", "word"), "id").groupBy("ids")
    spelt = spelt.agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    texts = F.array_join(F.transform("words", lambda w: w["word"].cast("string")), " ")
    rows = best.join(spelt.select("ids", "lang", texts.alias("phrase")), "ids")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    rows = _with(rows, stage(totals.select("lang", "n")), "lang")
    return rows.select(*[col(c) for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")])
