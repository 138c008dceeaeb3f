"""The thin queries over the operators of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, language_id, lm_scoring, minhash, packing, quality, substring_dedup, suffix_dedup, topk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), bpe.vocabulary_path("byte_bpe_50k.json"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest_fiftieth(table(spark, sf_dir, "embeddings"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.vocabulary_path("word_bpe_49k.json"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_exact_topk": op6_exact_topk,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_packing": op8_packing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_language_id": op10_language_id,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": """
        WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        win AS (SELECT doc_id, p, string_agg(word, ' ') OVER f AS body, count(*) OVER f AS n FROM each WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
        first AS (SELECT body, min(doc_id) AS first_doc FROM win WHERE n = 50 GROUP BY body HAVING min(doc_id) < max(doc_id)),
        gone AS (SELECT DISTINCT doc_id, p + unnest(range(0, 50)) AS p FROM win JOIN first USING (body) WHERE n = 50 AND first_doc < doc_id),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op6_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 5""",
}
