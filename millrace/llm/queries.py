"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.alignment import aligned
from millrace.llm.bpe_automaton import bpe_round_trip
from millrace.llm.chat import digests, formatted, from_turns
from millrace.llm.common import table
from millrace.llm.decontaminate import leaks
from millrace.llm.html_extract import extract
from millrace.llm.pieces import piece_round_trip
from millrace.llm.ppm import lm_scores
from millrace.llm.quality import judged
from millrace.llm.sharding import shard
from millrace.llm.simhash import near_duplicates
from millrace.llm.spelling import spelling_variants
from millrace.llm.token_counts import token_counts
from millrace.llm.warc import archived


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), distance=4, shingle=4)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), limit=2048)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=24)


def op5_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def op8_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose two texts are made of control strings."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return digests(formatted(from_turns(rows.union(planted)), unique=True))


def op9_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), least=6, least_n=5, ratio=5, one_in=199)


def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


OPS = (op1_simhash_near_dedup, op2_token_counts, op3_shards, op4_bpe_round_trip, op5_min_cut_text, op6_warc_round_trip, op7_host_rules, op8_reply_trees, op9_ppm_scores, op10_template_leaks, op11_spelling_variants, op12_piece_round_trip, op13_token_alignment)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPS}
ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op7_host_rules"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
     t AS (SELECT *, list_filter(string_split(translate(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS w,
                  list_filter(string_split(text, chr(10)), lambda x: translate(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13), '') <> '') AS lines FROM d),
     win AS (SELECT doc_id, i, w[i:i+4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
     rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
     cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY 1),
     s AS (SELECT t.doc_id, source, len(w) AS n_words, length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
                  length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
           FROM t LEFT JOIN cov USING (doc_id)),
     f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 3 * n_words OR word_chars > 10 * n_words AS soft_failed FROM s),
     h AS (SELECT source, count(*) AS docs, count(*) FILTER (base_failed OR soft_failed) AS failed FROM f GROUP BY 1),
     a AS (SELECT CAST(sum(docs) AS DOUBLE) AS n, CAST(sum(failed) AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS k, sum(CAST(docs AS DOUBLE) * docs) AS nn, sum(CAST(failed AS DOUBLE) * failed / docs) AS xx FROM h),
     c AS (SELECT x / n AS p, ((xx - x * x / n) / nullif(x * (n - x) / (n * n), 0) - (k - 1)) / nullif(n - nn / n - (k - 1), 0) AS r FROM a),
     q AS (SELECT p, CASE WHEN r > 0 THEN greatest(1.0, least(1e6, 1 / r - 1)) ELSE 1e6 END AS b FROM c),
     z AS (SELECT source, docs, b, p, (failed + p * b) / (docs + b) AS m FROM h, q),
     r AS (SELECT source, m - 3.0 * sqrt(m * (1 - m) / (docs + b + 1)) > 1.5 * p AS host_flagged FROM z)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (host_flagged AND soft_failed) AS kept, soft_failed, host_flagged
FROM f LEFT JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""

ORACLE_SQL["op8_reply_trees"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '<\\\1', 'g') AS s FROM c),
     f AS (SELECT *, length(regexp_replace(s, '\[(/?INST\])', '[\\\1', 'g')) + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(role) END AS n FROM e)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLE_SQL["op6_warc_round_trip"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
     k AS (SELECT h, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, url, n AS payload_bytes, sha1(p.h) AS payload_digest, CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.h = k.h
"""
