"""The registered query of each operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.local import small_frame
from tideline.llm.common import ship
from tideline.llm.exact import DigestIndex
from tideline.llm.fingerprints import fingerprints
from tideline.llm.lexical import ranked_search
from tideline.llm.mixing import mix_sources
from tideline.llm.neardup import Join, near_duplicates
from tideline.llm.negatives import hard_negatives
from tideline.llm.packing import pack
from tideline.llm.quality import classify
from tideline.llm.rules import quality_rules
from tideline.llm.secret_scan import BASE, by_position, of_kind, scan_secrets, span_text
from tideline.llm.tokens import count_tokens
from tideline.llm.urls import url_verdicts
from tideline.llm.warc import read_packages, write_packages
from tideline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    LLM_QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files are installed; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as packages and read back from them."""
    packages = write_packages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_packages(packages).select(
        F.col("id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


LLM_ORACLES["op1_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), firsts AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to nine tenths of the largest entropy; none is left out."""
    return mix_sources(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("lang")


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by four-word shingles at a similarity of 0.8."""
    found = near_duplicates(table(spark, sf_dir, "documents"), join=Join(words=4))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


# Equal sets are one class here too; classes that share a shingle are compared, links are closed.
LLM_ORACLES["op7_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))))
         END AS s
  FROM words
), keyed AS (
  SELECT doc_id, len(s)::BIGINT AS n, CASE WHEN len(s) > 0 THEN sha256(array_to_string(s, chr(10))) END AS key, s FROM sets
), classes AS MATERIALIZED (
  SELECT key, min(doc_id) AS class, any_value(n) AS n, any_value(s) AS s FROM keyed WHERE key IS NOT NULL GROUP BY key
), tokens AS MATERIALIZED (
  SELECT class, n, hash(unnest(s)) AS token FROM classes
), links AS MATERIALIZED (
  SELECT a.class AS a, b.class AS b
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.class < b.class
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.class, b.class
  HAVING 180 * count(*) >= 80 * (any_value(a.n) + any_value(b.n))
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(class, other) AS (
  SELECT class, class FROM classes
  UNION
  SELECT reached.class, ways.b FROM reached JOIN ways ON ways.a = reached.other
), parts AS (
  SELECT class, min(other) AS component FROM reached GROUP BY class
)
SELECT doc_id, keyed.n AS n_shingles, coalesce(component, doc_id) AS component_id,
       doc_id = coalesce(component, doc_id) AS kept
FROM keyed LEFT JOIN classes USING (key) LEFT JOIN parts USING (class)
"""


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch into a new index."""
    index = DigestIndex(spark, scratch_path(spark, "digest-index"))
    return index.add(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


LLM_ORACLES["op8_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The rules of the contract: (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the four rules; what no rule fits is allowed."""
    names = ("host", "path", "verdict")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rules = small_frame(spark, [dict(zip(names, rule)) for rule in URL_RULES], schema)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_verdicts(pages, rules).drop("url")


LLM_ORACLES["op9_url_filter"] = """
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), best AS (
  SELECT page_id, host, path,
         (SELECT max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, verdict := rule_verdict))
          FROM rules
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
  FROM (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path FROM parts)
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM best
"""


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.size(of_kind(F.col("base"), kind)).cast("bigint").alias(f"n_{kind}") for kind, _ in BASE
    ]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(by_position(F.col("base"), F.col("random"))).alias("spans"),
    )


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their edited texts and the documents that follow them."""
    return fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    found = ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


LLM_ORACLES["op12_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), postings AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, totals GROUP BY term
), impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS gain
  FROM postings JOIN weights USING (term) JOIN lengths USING (doc_id), totals
), scores AS (
  SELECT item_id, doc_id, sum(gain)::BIGINT AS score
  FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id HAVING sum(gain) > 0
)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
FROM scores
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER best <= 50
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth vector; labels are changed where the id is divisible by seven."""
    seventh = F.col("vec_id") % 7 == 0
    label = F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


LLM_ORACLES["op13_hard_negatives"] = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
         coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""
