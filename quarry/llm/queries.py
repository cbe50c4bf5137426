"""The registered queries of this package, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (conversation_repair, debruijn, decontam, ppm_langid, quality_rules, radix_dedup, secrets, sentencepiece_dropout,
                        simhash_vptree, site_template, suffix_dedup, url_rules, whitening)
from quarry.llm.common import read_table

#: Fixed rules of op8: host, path, action.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def is_held_out():
    """Rows that language identification never learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge-dropout encoding of every document, with its ids and the round-trip check."""
    return sentencepiece_dropout.encode(read_table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(read_table(spark, sf_dir, "documents"), window=20).drop("kept")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", is_held_out())
    return ppm_langid.predict(docs, ~F.col("held_out"), keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_template.main_text(read_table(spark, sf_dir, "pages"))


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=400).drop("kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(read_table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_secrets, op3_simhash, op4_decontamination, op5_repeated_words, op6_language, op7_quality,
                                   op8_url_rules, op9_main_text, op10_repeated_bytes, op11_conversation_repair, op12_whitening, op13_exact_duplicates)}

ORACLE = {
    "op13_exact_duplicates": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm""",
    "op8_url_rules": r"""
WITH cut AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(rule_host, rule_path, action) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC) AS k
  FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON c.page_id = f.page_id AND c.host = f.host AND c.path = f.path AND f.k = 1""",
    "op7_quality": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
grams AS (SELECT doc_id, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS g
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(words, lambda x: list_contains(string_split('STOPWORDS', ' '), lower(x))))::BIGINT AS n_stop,
             length(regexp_replace(text, '\P{Lu}+', '', 'g'))::BIGINT AS n_upper
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words AND n_symbols <= 0.2 * n_words
       AND n_dup_lines <= 0.5 * n_lines AND n_stop >= 0.02 * greatest(n_words - 50, 0) AND n_upper <= 0.4 * word_chars AS kept
FROM v""".replace("STOPWORDS", " ".join(quality_rules.STOP_WORDS)),
}
