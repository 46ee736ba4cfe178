"""Registered queries of the corpus operators, one for each, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontamination,
    exact_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    resampling,
    secret_scan,
    sharding,
    substring_dedup,
    suffix_array_dedup,
    token_files,
    toxicity,
    twins,
)
from tidemark.llm.work import table

SHARDS = 40


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"), keep="largest")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"), SHARDS)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.ranked(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_token_files, op3_suffix_array_dedup, op4_toxicity, op5_secret_scan,
        op6_exact_dedup, op7_decontamination, op8_sharding, op9_packing, op10_near_dedup,
        op11_resampling, op12_merkle_manifest, op13_mixing,
    )
}

def _repeats_sql(length: int) -> str:
    """Words of windows that also start earlier, by grouping all windows."""
    return rf"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(w[i : i + {length - 1}], ' ')) AS key
            FROM (SELECT *, unnest(range(1, len(w) - {length - 2})) AS i
                  FROM words WHERE len(w) >= {length})),
        late AS (
            SELECT doc_id, i FROM windows
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {length})) AS p FROM late),
        places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM words),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
            FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """


SQL: dict[str, str] = {
    "op1_substring_dedup": _repeats_sql(20),
    "op3_suffix_array_dedup": _repeats_sql(50),
    "op10_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
            FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 3))) AS i
                  FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(doc_id, other) AS (
            SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
        least AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles,
               least(doc_id, coalesce(m, doc_id)) AS component_id,
               doc_id <= coalesce(m, doc_id) AS kept
        FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_decontamination": r"""
        WITH item_words AS (
            SELECT item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
        item_windows AS (
            SELECT DISTINCT item_id, w[i : i + 9] AS key, least(len(w), 10) AS n
            FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 8))) AS i
                  FROM item_words WHERE len(w) > 0)),
        words AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        sizes AS (SELECT DISTINCT n FROM item_windows),
        windows AS (
            SELECT doc_id, i, n, w[i : i + n - 1] AS key
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM words, sizes WHERE len(w) >= n)),
        found AS (SELECT doc_id, i, n, item_id FROM windows JOIN item_windows USING (key, n)),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id)
        SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op11_resampling": twins.RESAMPLING,
    "op12_merkle_manifest": twins.MERKLE,
}
