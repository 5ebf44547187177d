"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import spread
from . import exact_dedup, html_extract, language_id, line_dedup, ngram_join, order_minhash, packing, sentence_pieces, substring_dedup, token_counts


#: The pattern that byte_bpe_50k cuts texts by.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is, for driver and workers."""
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.edited_counts(_documents(spark, sf_dir), token_counts.sample_edits(), tokenizer_path("byte_bpe_50k.tiktoken"), BYTE_PATTERN)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(_documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")).drop("ids")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(_documents(spark, sf_dir))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.pieces(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), with_ids=False).drop("ids")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(_documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(_documents(spark, sf_dir))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(spread(spark.read.parquet(f"{sf_dir}/pages.parquet")))


#: A-Z lower-cased and nothing else.
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_order_minhash": op2_order_minhash,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_html_extraction": op10_html_extraction,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_ASCII_LOWER} AS t FROM documents),
        c AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM n JOIN c USING (t)""",
    "op5_ngram_jaccard_join": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM w),
        c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * i >= 80 * (ca.n + cb.n - i)),
        r(node, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.node)
        SELECT r.node AS doc_id, coalesce(max(c.n), 0) AS n_shingles, min(r.m) AS component_id
        FROM r LEFT JOIN c ON c.doc_id = r.node GROUP BY r.node""",
    "op7_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
        late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
        gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS x FROM late GROUP BY doc_id),
        k AS (SELECT w.doc_id, w, list_filter(w, lambda v, i: NOT coalesce(list_contains(x, i), false)) AS kept FROM w LEFT JOIN gone USING (doc_id))
        SELECT doc_id, len(w) AS n_words, len(w) - len(kept) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""",
    "op8_line_dedup": r"""
        WITH RECURSIVE l AS (SELECT doc_id, i - 1 AS no, x[i] AS line FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
        o AS (SELECT * FROM l WHERE regexp_matches(line, '\S')),
        d AS (SELECT line, length(line) AS n, min((doc_id, no)) AS f FROM o GROUP BY line),
        e AS MATERIALIZED (SELECT a.line AS a, b.line AS b FROM d a JOIN d b ON b.n BETWEEN a.n - 2 AND a.n + 2 AND a.line <> b.line
            WHERE a.n >= 20 AND b.n >= 20 AND levenshtein(a.line, b.line) <= 2),
        r(line, m) AS (SELECT line, f FROM d UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.line),
        c AS (SELECT line, min(m) AS m FROM r GROUP BY line),
        k AS (SELECT l.doc_id, l.no, l.line, c.m IS NOT NULL AS counted, c.m IS NULL OR c.m = (l.doc_id, l.no) AS stays FROM l LEFT JOIN c USING (line))
        SELECT doc_id, count(*) FILTER (counted) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stays), '')) AS kept_sha256 FROM k GROUP BY doc_id""",
}
