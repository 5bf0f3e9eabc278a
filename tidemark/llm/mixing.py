"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import col
from tidemark.llm.shared import stage

WORD = r"[^\x20\x09-\x0D]+"
SLICES = (2, 5)  # hex digits of the order key that make slices of a source, and slices of those


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int) -> Column:
    """The seeded place of a document in its source's sampling order. Rows that agree
    in ``doc_id`` and text share a key, and share what the key is granted."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), F.coalesce(F.md5("text"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """Per source of ``sizes`` (source, size): ``source_size``, ``target`` and the
    copies of each document, ``copies`` whole ones and ``extra`` words of one more.

    Sources in code point order, NULL last, weigh ``weights`` in turn. Water rises in
    all of them by weight; a source is full at ``cap`` times its words, and what it
    cannot take goes to the others by weight. Ordered by cap over weight, the full
    sources come first, so each prefix is tried once: no loop. The table has one row
    per source, and only these rows meet in one task.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    table = table.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
    table = table.withColumn("cap", F.col("source_size") * F.lit(float(cap)))

    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    table = table.withColumns(
        {
            "_all": F.sum("source_size").over(everything) * F.lit(float(share)),
            "_full": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "_weights": F.sum("weight").over(from_here),
            "_rank": F.row_number().over(fill),
        }
    )
    level = (F.col("_all") - F.col("_full")) / F.col("_weights")
    table = table.withColumns({"_level": level, "_overflows": level * F.col("weight") > F.col("cap")})
    # the first source that takes its share of the level ends the full prefix
    first = F.min(F.when(~F.col("_overflows"), F.struct("_rank", "_level"))).over(everything)
    table = table.withColumn("_first", first)
    is_full = F.col("_first").isNull() | (F.col("_rank") < F.col("_first._rank"))
    target = F.when(is_full, F.col("cap")).otherwise(F.col("_first._level") * F.col("weight"))
    table = table.withColumn("target", F.least(target, F.col("cap")))
    copies = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0)
    table = table.withColumn("copies", copies.cast("long"))
    extra = F.floor("target") - F.col("copies") * F.col("source_size")
    return table.select("source", "source_size", "target", "copies", extra.cast("long").alias("extra"))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, cap: float = 3.0, seed: int = 6
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size`` (words), ``source_size``,
    ``target``, ``copies`` (whole repetitions), ``part`` (words of one further,
    fractional repetition) and ``taken`` (= copies * size + part).

    A source's documents all repeat floor(target / source_size) times. The rest of
    the target goes to its documents in the seeded order of their keys: one more copy
    each until it is used up, and the document at the edge gives only its first
    ``part`` words, so a source takes its target to the word.

    The edge is found without sorting a source: its words are summed by slices of the
    key, those of the slice that holds the edge by finer ones, and only a finest slice,
    a millionth of the source, is ordered. Texts are read, never
    shuffled. NULL text has no words; a NULL source is a source; rows that repeat a
    document share its grant evenly (rounded down); documents without words are taken
    0 words; an empty table gives an empty table. Columns of ``docs`` named like the
    added ones are replaced.
    """
    added = ("size", "source_size", "target", "copies", "part", "taken")
    # names of its own beside those of the user
    key, name, extra, edge, edge_words = (f"{c}-{uuid4().hex}" for c in ("key", "name", "extra", "edge", "words"))
    rows = docs.drop(*added).withColumns({"size": word_count(F.col("text")), key: order_key(seed)})
    # a narrow table of what the rest needs: texts are counted here and once more at the end
    sizes = stage(rows.select("source", "size", F.col(key).alias("_key")))
    sources = source_targets(sizes, weights, share, cap).withColumnRenamed("source", "_source")
    # tables of one row per source: once their size is known, Spark broadcasts them if it is small
    sources = stage(sources.withColumn("_source", _named("_source")))

    keyed = sizes.select(_named("source").alias("_source"), "size", "_key")
    edges, known = sources.select("_source", F.lit("").alias("_slice"), F.col("extra").alias("left")), 0
    for digits in SLICES:
        edges, known = stage(_edge_slices(keyed, edges, known, digits)), digits
    groups = (
        keyed.withColumn("_slice", F.substring("_key", 1, known))
        .join(edges, ["_source", "_slice"])
        .groupBy("_source", "_key", "left")
        .agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    )
    last = _reached(groups, "_key").select(
        "_source",
        F.col("_key").alias("_edge"),
        F.floor((F.col("left") - F.col("_before")) / F.col("rows")).alias("_edge_words"),
    )
    renamed = {"_source": name, "extra": extra, "_edge": edge, "_edge_words": edge_words}
    sources = stage(sources.join(last, "_source", "left").withColumnsRenamed(renamed))

    result = rows.withColumn(name, _named("source")).join(sources, name, "left")
    goes = F.col(edge).isNull() & (F.col(extra) > 0) | (F.col(key) < F.col(edge))
    part = F.when(F.col(key) == F.col(edge), F.col(edge_words)).otherwise(0)
    result = result.withColumns(
        {
            "copies": F.col("copies") + F.when(goes, 1).otherwise(0),
            "part": part.cast("long"),
        }
    )
    result = result.withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))
    return result.select(*[col(c) for c in docs.columns if c not in added], *added)


def _reached(pieces: DataFrame, order: str) -> DataFrame:
    """Of each source's ``pieces`` (words, left), in order, the one that ``left`` ends in."""
    upto = Window.partitionBy("_source").orderBy(order)
    pieces = pieces.withColumn("_before", F.sum("words").over(upto) - F.col("words"))
    return pieces.where("_before <= left and left < _before + words")


def _edge_slices(keyed: DataFrame, edges: DataFrame, known: int, digits: int) -> DataFrame:
    """The slice of each source that holds its edge, to ``digits`` digits of the key."""
    pieces = (
        keyed.withColumn("_slice", F.substring("_key", 1, known))
        .join(edges, ["_source", "_slice"])
        .groupBy("_source", "left", F.substring("_key", 1, digits).alias("_next"))
        .agg(F.sum("size").alias("words"))
    )
    return _reached(pieces, "_next").select("_source", F.col("_next").alias("_slice"), (F.col("left") - F.col("_before")).alias("left"))


def _named(source: str) -> Column:
    """A source's join key: NULL is a key of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def repeat_documents(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as ``copies`` says, and its first
    ``part`` words (joined by single spaces) as one more row, marked ``_is_part``."""
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    partial = F.array_join(F.slice(words, 1, F.col("part").cast("int")), " ")
    whole = F.array_repeat(F.lit(False), F.col("copies").cast("int"))
    pieces = F.concat(whole, F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array()))
    rows = mixed.withColumn("_is_part", F.explode(pieces))
    return rows.withColumn("text", F.when(F.col("_is_part"), partial).otherwise(F.col("text")))
