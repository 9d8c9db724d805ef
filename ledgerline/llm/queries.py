"""Registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    byte_bpe, html_extract, importance, lexical_search, merkle, packing, quality_rules, ranking_sql, sharding, simhash, spelling,
    suffix_dedup, token_counts, warc,
)
from ledgerline.llm.common import SPACE_CLASS, read_table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest_documents(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return importance.classify(read_table(spark, sf_dir, "documents"), labels).drop("_key")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure(read_table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), model)


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare(read_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages")).drop("url")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(read_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents"), sharding.layout(8), sharding.layout(8, opened=1))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_token_counts": op6_token_counts,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_warc": op8_warc,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_sharding": op11_sharding,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op8_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
        FROM p LEFT JOIN f ON payload_bytes >= 100 AND p.payload_digest = f.payload_digest
    """,
    "op9_quality_rules": f"""
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT r, list_filter(string_split_regex(text, '{SPACE_CLASS}+'), lambda x: x <> '') AS words FROM t
        ), win AS (
            SELECT r, i, array_to_string(words[i:i + 4], ' ') AS win
            FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
        ), twice AS (
            SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM win) WHERE c > 1
        ), again AS (
            SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS at FROM twice, range(0, 5) g(k)) GROUP BY r
        ), l AS (
            SELECT r, line, len(regexp_extract_all(line, '[^{SPACE_CLASS[1:]}+')) AS n,
                   length(regexp_replace(line, '{SPACE_CLASS}', '', 'g')) AS chars,
                   length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
                   length(regexp_replace(line, '[^{quality_rules.SEPARATORS}]', '', 'g')) AS separators,
                   length(regexp_replace(line, '[^!]', '', 'g')) AS marks,
                   length(regexp_replace(line, '[^{quality_rules.UPPER}]', '', 'g')) AS upper,
                   length(regexp_replace(line, '[^{quality_rules.LOWER}]', '', 'g')) AS lower
            FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
        ), lines AS (
            SELECT r, sum(n) AS n, sum(chars) AS chars, sum(symbols) AS symbols,
                   count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS dup,
                   coalesce(sum(chars) FILTER (chars > 0 AND (
                       (symbols >= 3 AND symbols * 5 >= n) OR (marks >= 3 AND marks * 3 >= n)
                       OR (n >= 20 AND NOT regexp_matches(line, '{quality_rules.SENTENCE_MARKS}'))
                       OR (separators >= 2 AND separators * 3 >= n)
                       OR (n >= 4 AND upper > 3 * lower)
                       OR (n <= {quality_rules.STOCK_WORDS}
                           AND regexp_matches(lower(line), '{"|".join(quality_rules.STOCK_PHRASES)}'))
                   )), 0) AS lost
            FROM l GROUP BY r
        ), q AS (
            SELECT doc_id, lines.n::BIGINT AS n_words, chars::BIGINT AS word_chars, symbols::BIGINT AS n_symbols,
                   dup::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words, lost
            FROM t JOIN lines USING (r) LEFT JOIN (SELECT r, n FROM again) again USING (r)
        ), q2 AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM q)
        SELECT * EXCLUDE (lost), NOT base_failed AND lost * 100 <= word_chars * 30 AS kept FROM q2
    """,
    "op11_sharding": ranking_sql.SHARDING,
    "op12_lexical_search": ranking_sql.SEARCH,
    "op13_spelling_variants": ranking_sql.SPELLING,
}
