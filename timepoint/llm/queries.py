"""One query per operator over the driver's tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timepoint.llm import (
    crc_checks,
    fingerprints,
    grades,
    licenses,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality_rules,
    spelling,
    substring_dedup,
    token_counts,
    topk,
    wrappers,
)
from timepoint.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return grades.quality_grades(docs, labels)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = quality_rules.base_failed()
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & quality_rules.passes()).alias("kept"),
        "failed",
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model")
    )


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.drop("passages", "removable")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_mixing": op2_mixing,
    "op3_grades": op3_grades,
    "op4_main_text": op4_main_text,
    "op5_packing": op5_packing,
    "op6_licenses": op6_licenses,
    "op7_top_k": op7_top_k,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_substrings": op10_substrings,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling": op12_spelling,
    "op13_fingerprints": op13_fingerprints,
}
#: The word separators of ``common.WORD`` in SQL text.
_BLANKS = r"\x20\x09-\x0D"


def _op8_sql() -> str:
    bits = " + ".join(
        f"CASE WHEN {failed} THEN {1 << bit} ELSE 0 END"
        for bit, failed in enumerate(quality_rules.RULES.values())
    )
    base, whole = (
        quality_rules.mask_of(quality_rules.POLICIES[p]) for p in ("base", quality_rules.CURRENT)
    )
    return rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
        ), split AS (
            SELECT row_no, doc_id, text, regexp_extract_all(text, '[^{_BLANKS}]+') AS words,
                   list_filter(string_split(text, chr(10)),
                               lambda l: regexp_matches(l, '[^{_BLANKS}]')) AS lines
            FROM texts
        ), placed AS (
            SELECT row_no, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split
        ), triples AS (
            SELECT row_no, i, word, lead(word, 1) OVER w AS word2, lead(word, 2) OVER w AS word3
            FROM placed WINDOW w AS (PARTITION BY row_no ORDER BY i)
        ), again AS (
            SELECT row_no, i, count(*) OVER (PARTITION BY row_no, word, word2, word3) AS n
            FROM triples WHERE word3 IS NOT NULL
        ), covered AS (
            SELECT row_no, count(DISTINCT i + k) AS n_repeat_words
            FROM again, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY row_no
        ), tops AS (
            SELECT row_no, max(n) AS top_word
            FROM (SELECT row_no, word, count(*) AS n FROM placed GROUP BY ALL) GROUP BY row_no
        ), measures AS (
            SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(text, '[{_BLANKS}]', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                   len(lines) AS n_lines, coalesce(top_word, 0) AS top_word,
                   length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS n_upper,
                   length(regexp_replace(text, '\P{{L}}', '', 'g')) AS n_letters,
                   len(list_filter(words, lambda x: x LIKE '%!!')) AS n_exclaimed
            FROM split LEFT JOIN covered USING (row_no) LEFT JOIN tops USING (row_no)
        ), judged AS (SELECT *, CAST({bits} AS BIGINT) AS failed FROM measures)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failed & {base} <> 0 AS base_failed, failed & {whole} = 0 AS kept, failed
        FROM judged
    """


_OP1_SQL = rf"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^{_BLANKS}]+') AS words
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words
                                     ELSE list_slice(words, i, i + 4) END AS shingle
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
              FROM split WHERE len(words) > 0)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_common
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY ALL
    ), links AS (
        SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * n_common >= 85 * (x.n + y.n - n_common)
    ), reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
    ), lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
           d.doc_id = component_id AS kept
    FROM documents d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

CHECKS: dict[str, str] = {
    "op1_near_duplicates": _OP1_SQL,
    "op8_quality_rules": _op8_sql(),
    "op11_prefix_trie": crc_checks.OP11,
    "op12_spelling": crc_checks.OP12,
    "op7_top_k": """
        WITH parts AS (
            SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        ), whole AS (
            SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS q FROM parts
            WHERE vec_id NOT IN (
                SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)
            )
        ), scores AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.q * b.q) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.i = b.i AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scores
        ) SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
