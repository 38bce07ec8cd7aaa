"""The operators as named queries over whole tables, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from curbline.llm.byte_bpe import byte_bpe_digest
from curbline.llm.code_search import nearest_by_sign
from curbline.llm.common import table
from curbline.llm.exact_dedup import exact_duplicates
from curbline.llm.fill_in_middle import fill_in_middle_digest
from curbline.llm.language_id import identify_languages
from curbline.llm.line_dedup import line_digest
from curbline.llm.mixing import Mix
from curbline.llm.near_dedup import near_duplicates
from curbline.llm.packing import pack_documents, piece_digest
from curbline.llm.personal_data import personal_data_digest
from curbline.llm.secret_scan import secret_digest
from curbline.llm.token_alignment import alignment_digest
from curbline.llm.url_filter import Rule, judge_urls

RULES = [
    Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"),
]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES, inherit=True)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(pack_documents(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


def op6_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_by_sign(table(spark, sf_dir, "embeddings"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).taken()


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digest(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digest(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_personal_data": op3_personal_data,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_code_search": op6_code_search,
    "op7_near_dedup": op7_near_dedup,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_alignment": op12_token_alignment,
    "op13_byte_bpe": op13_byte_bpe,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
    """,
    "op5_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
        k AS (
            SELECT doc_id, line, pos, translate(regexp_replace(regexp_replace(line,
                       '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        s AS (
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (
            SELECT k.doc_id, k.line, k.pos, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
            FROM k LEFT JOIN s USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op6_code_search": r"""
        WITH c AS (
            SELECT vec_id, CAST(array_to_string(list_transform(embedding[1:64],
                       lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS BIT) AS code
            FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
        p AS (
            SELECT q.vec_id AS query_id, r.vec_id, bit_count(xor(q.code, r.code)) AS distance
            FROM c AS q, c AS r WHERE q.vec_id % 20 = 0),
        n AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM p)
        SELECT query_id, rank, vec_id, distance FROM n WHERE rank <= 10
    """,
    "op11_fill_in_middle": """
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
            FROM documents),
        h AS (
            SELECT doc_id, text, n, CAST('0x' || hex[1:8] AS UBIGINT) % (n + 1) AS u1,
                   CAST('0x' || hex[9:16] AS UBIGINT) % (n + 1) AS u2,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR CAST('0x' || hex[17:24] AS UBIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST('0x' || hex[25:32] AS UBIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM t),
        p AS (
            SELECT *, substring(text, 1, CAST(least(u1, u2) AS BIGINT)) AS prefix,
                   substring(text, CAST(least(u1, u2) + 1 AS BIGINT), CAST(greatest(u1, u2) - least(u1, u2) AS BIGINT)) AS middle,
                   substring(text, CAST(greatest(u1, u2) + 1 AS BIGINT)) AS suffix
            FROM h)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                               WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                               ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
        FROM p
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
