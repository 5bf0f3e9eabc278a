"""From documents to training sequences: quality, near-duplicates, secrets, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_sources, repeat_documents
from tidemark.llm.packing import pack_pow2
from tidemark.llm.quality import quality_scores
from tidemark.llm.queries import TOKENIZER, table
from tidemark.llm.secret_ledger import redacted, scan_versions
from tidemark.llm.shared import scratch, stage
from tidemark.llm.simhash import keep_one

LEAST_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches LEAST_QUALITY, unchanged, in whatever number
    a row repeats. Learns from the labels that the held-out fold leaves. NULL and empty
    texts have a score like any other; an empty table gives an empty one."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    scored = quality_scores(docs, labels)
    return scored.where(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at three
    bits or fewer: that of the smallest doc_id, unchanged. NULL and empty texts are
    copies of each other; rows that share an id are told apart by their content."""
    return keep_one(docs, radius=3, shingle=3, seed=42)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in a text replaced by ``[secret]``; ``n_chars`` follows.
    NULL text stays NULL; repeated rows and NULLs in other columns pass through."""
    found = scan_versions(docs, f"{scratch(spark)}/ledger")
    found = found.withColumn("_text", redacted(F.col("text"), F.col("spans")))
    length = F.when(F.size("spans") > 0, F.char_length("_text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).withColumn("text", F.col("_text")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks; ``n_chars`` follows where a
    repetition is partial. A NULL source is one; texts without words (NULL too) go as
    often as their source's whole repetitions; equal rows share their grant."""
    mixed = repeat_documents(mix_sources(docs, weights=(1, 2, 3), share=1.0, cap=3.0, seed=6))
    partial = F.char_length("text").cast("long")
    return mixed.withColumn("n_chars", F.when(F.col("_is_part"), partial).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length: doc_id, start, length, token ids, place. Each row
    is a document, NULL and empty texts being one id; an empty table has no sequences."""
    return pack_pow2(docs, TOKENIZER, end_id=2, longest=4096)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("mix", mix),
    ("pack", pack),
]

# no stage but the mix can be said in SQL: a test follows the rows stage by stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all of ``documents``, each result a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
