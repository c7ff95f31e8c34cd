"""Queries of the text operators over the driver tables, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideledger.llm import (
    bpe_codec,
    decontaminate,
    exact_dedup,
    lexical_search,
    licenses,
    ngram_join,
    packing,
    pii,
    prefix_trie,
    quality,
    suffix_dedup,
    token_counts,
    token_output,
)
from tideledger.llm.common import documents
from tideledger.session import new_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), with_text=False).drop("kept")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), BYTE_BPE)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(documents(spark, sf_dir), ngram_join.Similarity(width=3, over=9, under=10))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), BYTE_BPE)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(documents(spark, sf_dir)))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_output.write_token_ids(documents(spark, sf_dir), BYTE_BPE, new_path(spark, "token-ids"))
    return token_output.token_digests(spark, path)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trips(documents(spark, sf_dir), WORD_BPE)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.best_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_benchmark_decontamination,
        op3_best_fit_packing,
        op4_ngram_jaccard_join,
        op5_token_counts,
        op6_exact_dedup,
        op7_quality_classifier,
        op8_personal_data,
        op9_token_output,
        op10_license_scan,
        op11_bpe_codec,
        op12_lexical_search,
        op13_prefix_trie,
    )
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)
    """,
    "op12_lexical_search": """
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM documents),
        asked AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
                  FROM benchmark)
            GROUP BY ALL),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
        held AS (SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM held, whole GROUP BY term),
        impacts AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS impact
            FROM held JOIN sizes USING (doc_id) JOIN weights USING (term), whole),
        scores AS (
            SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score
            FROM impacts JOIN asked USING (term) GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 10
    """,
    "op13_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
                   coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS shown FROM turns),
        heads AS (
            -- CRC-32 bit by bit
            SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
                list_concat([4294967295::BIGINT], range(8 * length(shown))),
                lambda crc, i: xor(
                    (CASE WHEN i % 8 = 0 THEN xor(crc, ascii(shown[i // 8 + 1])::BIGINT) ELSE crc END) >> 1,
                    CASE WHEN ((CASE WHEN i % 8 = 0 THEN xor(crc, ascii(shown[i // 8 + 1])::BIGINT) ELSE crc END) & 1) = 1
                         THEN 3988292384::BIGINT ELSE 0 END)), 4294967295::BIGINT) % 4 AS h
            FROM ids),
        headed AS (
            SELECT h.conv_id, place AS depth, role, text FROM heads h JOIN turns t ON t.conv_id = base AND place <= h),
        lengths AS (SELECT h.conv_id, h, count(depth) AS k FROM heads h LEFT JOIN headed USING (conv_id) GROUP BY ALL),
        rebuilt AS (
            FROM headed UNION ALL
            SELECT conv_id, k + place - h, role, text FROM lengths JOIN turns USING (conv_id) WHERE place > h),
        members AS (
            SELECT conv_id, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_words,
                   string_agg(md5(length(role) || ':' || role || text), '' ORDER BY depth)
                       OVER (PARTITION BY conv_id ORDER BY depth) AS path
            FROM rebuilt UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
        nodes AS (
            SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_words) AS n_words,
                   left(path, 32 * (depth - 1)::INT) AS above
            FROM members GROUP BY depth, path),
        children AS (SELECT above AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        described AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path, depth)),
        below AS (
            SELECT m.depth, m.path, sum((n.n_convs - 1) * n.n_words)::BIGINT AS saved_tokens,
                   count(*) FILTER (n.n_children = 0) AS n_leaves
            FROM described n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY ALL),
        finals AS (
            SELECT conv_id, depth, path FROM members QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)),
        ends AS (
            SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM finals GROUP BY depth, path)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens,
               sha256(coalesce(ids, '')) AS ends_sha256
        FROM described n JOIN below b USING (depth, path) LEFT JOIN ends USING (depth, path)
        LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.above
    """,
}
