"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import parted, stage
from tidemark.operators import few_keys, fits_by_rows
from tidemark.sources.filesystem import Directory

SPAN = "struct<kind:string,start:long,end:long>"
CHUNK = 256  # items that a running result takes before it is put aside
BLOCK = 2048  # characters that a text is cut into to be read by position
LEDGER = f"blob string, rule string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping) whose ``group`` has at least
    ``min_chars`` characters. A changed rule takes a new ``version``."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# fixed values: the patterns that are asked for. A run of AKIA or hex characters that
# is too short holds no long enough one, so their lengths stand in the pattern.
RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_chars=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)


def _running(items: Column, state: Column, step: Callable[[Column, Column], Column], made: str) -> Column:
    """A fold over ``items`` whose ``step`` gives a struct of the next ``at`` and ``made``,
    what the item adds to the result (an array of none or more). The result grows by
    chunks that are joined at the end, so the time is linear in the items."""
    none = F.array().cast(made)

    def chunk(own: Column, before: Column, n: Column) -> Column:
        def one(inner: Column, item: Column) -> Column:
            new = step(inner["at"], item)
            return F.struct(new["at"].alias("at"), F.concat(inner["made"], new["made"]).alias("made"))

        first = F.struct(before["at"].alias("at"), none.alias("made"))
        inner = F.aggregate(F.slice(own, n * CHUNK + 1, CHUNK), first, one)
        # a list of one, so that the chunk is worked out once
        joined = lambda x: F.struct(x["at"].alias("at"), F.concat(before["made"], F.array(x["made"])).alias("made"))
        return F.transform(F.array(inner), joined)[0]

    def whole(own: Column) -> Column:
        first = F.struct(state.alias("at"), F.array().cast(f"array<{made}>").alias("made"))
        chunks = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / CHUNK).cast("int"))
        return F.aggregate(chunks, first, lambda before, n: chunk(own, before, n), lambda x: F.flatten(x["made"]))

    # the items too are worked out once, not for each chunk
    return F.transform(F.array(items), lambda own: F.when(F.size(own) > 0, whole(own)).otherwise(none))[0]


def spans_of(text: Column, rule: Rule) -> Column:
    """The rule's spans in ``text``: code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    # what lies between the matches, the matches, and what is measured of them
    pieces = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, 0).alias("hit"),
        F.regexp_extract_all(text, pattern, rule.group).alias("part"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(at: Column, piece: Column) -> Column:
        start = at + F.char_length(piece["gap"])
        end = start + F.coalesce(F.char_length(piece["hit"]), F.lit(0))
        span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"))
        good = F.char_length(piece["part"]) >= rule.min_chars
        return F.struct(end.alias("at"), F.when(good, F.array(span)).otherwise(none).alias("made"))

    found = _running(pieces, F.lit(0).cast("long"), step, f"array<{SPAN}>")
    return F.when(text.rlike(rule.pattern), found).otherwise(none)


def scan_versions(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``versions`` (text and any other columns, one row per path and version) with
    ``blob`` (SHA-256 of the text) and ``spans``, ordered by start, then by rule.

    The ledger at ``ledger`` holds a row per blob and rule version that was ever
    scanned. Only pairs that it lacks are scanned, each blob once however many paths
    and versions hold it, and appended; then all findings of the rules are joined back
    to all rows. A second run over the same history scans nothing. NULL text is the
    empty blob; repeated rows stay repeated; an empty table leaves the ledger as it
    is. Columns named ``blob`` or ``spans`` are replaced.

    Texts move once, and where few are new, only those; copies meet before the
    shuffle. The join back moves no texts if the findings can be broadcast; beyond that
    only those that a bit map of the blobs with findings lets through, whose size does
    not grow.
    """
    spark = versions.sparkSession
    columns = [c for c in versions.columns if c not in ("blob", "spans")]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = versions.select(*columns, F.sha2(text, 256).alias("blob"))
    keys = F.array(*[F.lit(r.key) for r in rules])

    blobs = rows.select("blob", text.alias("text"))
    if Directory(spark, ledger).exists():
        seen = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule").isin([r.key for r in rules]))
        # as many rules as there are, per blob
        seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        pending = rows.select("blob").distinct().join(seen, "blob", "left")
        pending = pending.withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        pending = stage(pending.where(F.size(F.array_except(keys, "seen")) > 0))
        few = few_keys(pending, ["blob"])
        if few is not None:  # texts of known blobs do not move at all
            blobs = blobs.join(few, "blob", "left_semi")
        blobs = blobs.dropDuplicates(["blob"]).join(pending, "blob")
    else:
        blobs = blobs.dropDuplicates(["blob"]).withColumn("seen", F.array().cast("array<string>"))
    found = [
        F.when(
            ~F.array_contains("seen", r.key),
            F.struct(F.lit(r.key).alias("rule"), spans_of(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ]
    unseen = blobs.select("blob", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())))
    unseen.select("blob", "col.rule", "col.spans").write.mode("append").parquet(ledger)

    rank = reduce(lambda c, n: c.when(F.col("rule") == rules[n].key, n), range(1, len(rules)), F.when(F.col("rule") == rules[0].key, 0))
    hits = (
        spark.read.schema(LEDGER)
        .parquet(ledger)
        .where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "rule"])  # a cut-off and repeated append
        .withColumn("ranked", F.transform("spans", lambda s: F.struct(s["start"], rank.alias("rank"), s["end"], s["kind"])))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("ranked")).alias("ranked"))
    )
    ordered = F.transform(F.array_sort("ranked"), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    hits = stage(hits.select("blob", ordered.cast(f"array<{SPAN}>").alias("spans")))
    return _joined_back(rows, hits).select(*columns, "blob", "spans")


def _joined_back(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """``rows`` with the spans of their blobs, none where ``hits`` has no row."""
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.coalesce("spans", none)
    if fits_by_rows(hits):
        return rows.join(F.broadcast(hits), "blob", "left").withColumn("spans", spans)
    maybe, without = parted(rows, hits, "blob")
    return maybe.join(hits, "blob", "left").withColumn("spans", spans).unionByName(without.withColumn("spans", none))


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with its spans (ordered by start) replaced; those that overlap become one.

    The time is linear in text and spans: what stays is cut from blocks of BLOCK
    characters, since Spark counts a position from the start of its string."""
    gap = "array<struct<start:long,end:long>>"

    def step(at: Column, s: Column) -> Column:
        kept = F.array(F.struct(at.alias("start"), s["start"].alias("end")))
        made = F.when(s["start"] >= at, kept).otherwise(F.array().cast(gap))
        return F.struct(F.greatest(at, s["end"]).alias("at"), made.alias("made"))

    gaps = _running(spans, F.lit(0).cast("long"), step, gap)
    last = F.struct(F.array_max(spans["end"]).alias("start"), F.char_length(text).cast("long").alias("end"))

    def cut(blocks: Column, g: Column) -> Column:
        def of_block(n: Column) -> Column:
            low = F.greatest(g["start"] - n * BLOCK, F.lit(0)).cast("int")
            high = F.least(g["end"] - n * BLOCK, F.lit(BLOCK)).cast("int")
            return F.substring(blocks[n], low + 1, high - low)

        numbers = F.sequence(F.floor(g["start"] / BLOCK).cast("int"), F.floor((g["end"] - 1) / BLOCK).cast("int"))
        return F.when(g["start"] >= g["end"], F.lit("")).otherwise(F.array_join(F.transform(numbers, of_block), ""))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), 0)
    kept = F.concat(gaps, F.array(last.cast("struct<start:long,end:long>")))
    out = F.transform(F.array(blocks), lambda own: F.array_join(F.transform(kept, lambda g: cut(own, g)), mark))[0]
    return F.when(F.size(spans) > 0, out).otherwise(text)
