"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.collocations import collocations
from tidemark.llm.embedding_links import embedding_groups
from tidemark.llm.language import language_scores
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_pow2
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.quality import quality_scores
from tidemark.llm.secret_ledger import scan_versions, spans_text
from tidemark.llm.shared import scratch
from tidemark.llm.sharding import shard_documents
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.syncmers import fingerprint_documents
from tidemark.llm.vector_codes import compress_vectors, summed_over
from tidemark.llm.warc import read_warc, with_revisits, write_warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = embedding_groups(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold=0.9)
    return groups.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), radius=3, shingle=3, seed=42)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_versions(docs, f"{scratch(spark)}/ledger")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
        for k in ("assign", "access", "hex")
    ]
    # all rules are base rules
    found = found.select("doc_id", *counts, spans_text(F.col("spans")).alias("spans"))
    return found.withColumn("base_sha256", F.sha2("spans", 256))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_revisits(table(spark, sf_dir, "pages"), "page_id", "html")
    folder = f"{scratch(spark)}/warc"
    renamed = {"page_id": "key", "url": "uri", "html": "payload"}
    write_warc(pages.select(*[F.col(c).alias(renamed.get(c, c)) for c in pages.columns]), folder)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    return read_warc(spark, folder, payloads=False).select(
        number("record_id").try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").try_cast("long").alias("refers_to"),
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), weights=(1, 2, 3), share=1.0, cap=3.0, seed=6)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = quality_scores(docs, labels.where(~held_out))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    learned = docs.where(~held_out & F.col("lang").isNotNull())
    return language_scores(docs, learned).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "rejected"
    )


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=16)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_pow2(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2, longest=4096)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(table(spark, sf_dir, "documents"), PIECES, decoded=True).select("doc_id", "ids", "decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    coded, books = compress_vectors(vectors, "vec_id", "embedding", parts=4, entries=256, rounds=4)
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")))
    coded = summed_over(coded.select("vec_id", "label", F.array_join(digits, "").alias("code"), "error"), "label", "error", "label_error")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_links": op1_embedding_links,
    "op2_syncmers": op2_syncmers,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_warc": op5_warc,
    "op6_mix": op6_mix,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_shards": op9_shards,
    "op10_pack": op10_pack,
    "op11_pieces": op11_pieces,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
}

def _vector_codes_sql(rounds: int = 4) -> str:
    """Lloyd rounds written out, each a step of assigning and one of moving."""
    steps = ""
    for n in range(rounds + 1):
        steps += f""",
near{n} AS MATERIALIZED (
  SELECT i, p.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT p.i, p.part, b.entry,
               list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.x, b.x)])::BIGINT AS d
        FROM parts p JOIN book{n} b ON p.part = b.part) p
  GROUP BY i, p.part)"""
        if n < rounds:
            steps += f""",
mean{n} AS (
  SELECT part, entry, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY j) AS x
  FROM (SELECT n.part, n.entry, j, sum(p.x[j]) AS s, count(*) AS c
        FROM near{n} n JOIN parts p ON n.i = p.i AND n.part = p.part, range(1, 17) AS js(j) GROUP BY ALL)
  GROUP BY part, entry),
book{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM book{n} b LEFT JOIN mean{n} m ON b.part = m.part AND b.entry = m.entry)"""
    return f"""
WITH good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS i
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding::DOUBLE[] if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
  SELECT i, part, [floor(1024 * x)::BIGINT for x in v[16 * part + 1:16 * part + 16]] AS x
  FROM good, range(4) AS ps(part)),
book0 AS (SELECT part, i AS entry, x FROM parts WHERE i < 256){steps},
coded AS (
  SELECT i, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM near{rounds} GROUP BY i),
said AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM good JOIN coded USING (i) CROSS JOIN said
"""


ORACLE_SQL = {
    "op12_vector_codes": _vector_codes_sql(),
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
runs AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, 5) AS ks(k) WHERE len(w) >= k),
f AS MATERIALIZED (
  SELECT lang, w[i:i + k - 1] AS p, k AS size, count(*) AS a FROM runs GROUP BY lang, p, size HAVING count(*) >= 30),
inner_parts AS (
  SELECT lang, size, a, p, j, unnest(range(1, size - j + 2)) AS i FROM f, range(2, 4) AS js(j) WHERE j < size),
held AS (SELECT lang, p[i:i + j - 1] AS p, max(a) AS most FROM inner_parts GROUP BY lang, p[i:i + j - 1]),
kept AS (
  SELECT f.* FROM f LEFT JOIN held USING (lang, p)
  WHERE f.size > 1 AND (most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * f.a)),
cuts AS (SELECT *, unnest(range(1, size)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.p, c.a, c.cut, l.a AS l, r.a AS r, ((2000000::HUGEINT * c.a) // (l.a + r.a))::BIGINT AS score
  FROM cuts c JOIN f l ON c.lang = l.lang AND l.p = c.p[1:c.cut]
  JOIN f r ON c.lang = r.lang AND r.p = c.p[c.cut + 1:c.size]),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS nth FROM scored),
listed AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM lowest WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM listed JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op1_embedding_links": """
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT vec_id, v, sqrt(list_sum([x * x for x in v])) AS norm FROM vectors
  WHERE len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in v if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
reached AS (
  SELECT vec_id AS id, vec_id AS low FROM vectors
  UNION SELECT links.b, reached.low FROM reached JOIN links ON links.a = reached.id),
lowest AS (SELECT id, min(low) AS component_id FROM reached GROUP BY id),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN lowest ON vec_id = id LEFT JOIN degree ON vec_id = a
""",
    "op4_secrets": r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
pieces AS (
  SELECT doc_id, 'assign' AS kind, 0 AS rank, 8 AS least, string_split_regex(t, p) AS gaps,
         regexp_extract_all(t, p, 0) AS hits, regexp_extract_all(t, p, 2) AS parts
  FROM docs, (SELECT '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
  UNION ALL
  SELECT doc_id, 'access', 1, 16, string_split_regex(t, p), regexp_extract_all(t, p, 0), regexp_extract_all(t, p, 0)
  FROM docs, (SELECT 'AKIA[A-Z0-9]+' AS p)
  UNION ALL
  SELECT doc_id, 'hex', 2, 32, string_split_regex(t, p), regexp_extract_all(t, p, 0), regexp_extract_all(t, p, 0)
  FROM docs, (SELECT '[0-9a-f]{16,}' AS p)),
numbered AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM pieces),
placed AS (
  SELECT doc_id, kind, rank, length(hits[i]) AS n, length(parts[i]) >= least AS good,
         (list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0))::BIGINT AS b
  FROM numbered),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, rank) AS spans
  FROM placed WHERE good GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM docs LEFT JOIN found USING (doc_id)
""",
    "op5_warc": """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
heads AS (SELECT payload_digest, min(page_id) AS head FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM sized LEFT JOIN heads USING (payload_digest)
""",
    "op6_mix": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('6:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS k
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS weight
  FROM sized GROUP BY source),
capped AS (SELECT *, source_size * 3.0::DOUBLE AS cap FROM named),
filled AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weights,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank
  FROM capped),
levels AS (SELECT *, (total - full_words) / weights AS level FROM filled),
first AS (SELECT min(rank) AS rank, min_by(level, rank) AS level FROM levels WHERE NOT level * weight > cap),
targets AS (
  SELECT l.source, l.source_size,
         least(CASE WHEN f.rank IS NULL OR l.rank < f.rank THEN cap ELSE f.level * weight END, cap) AS target
  FROM levels l CROSS JOIN first f),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size)::BIGINT ELSE 0 END AS copies
  FROM targets),
keys AS (
  SELECT source, k, sum(size)::BIGINT AS words, count(*) AS n,
         (sum(sum(size)) OVER (PARTITION BY source ORDER BY k))::BIGINT - sum(size)::BIGINT AS before
  FROM sized GROUP BY source, k),
parts AS (
  SELECT keys.source, k, target, source_size, copies, n, words, before,
         floor(target)::BIGINT - copies * source_size AS extra
  FROM keys JOIN goals ON keys.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, source_size, target,
       copies * size + CASE WHEN before + words <= extra THEN size
                            WHEN before <= extra THEN (extra - before) // n ELSE 0 END AS taken
FROM sized JOIN parts ON sized.k = parts.k AND sized.source IS NOT DISTINCT FROM parts.source
""",
}
