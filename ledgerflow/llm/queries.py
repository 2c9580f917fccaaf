"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, jaccard, negatives, packing, periodic, pii, quality, secrets, sentences, suffix, token_store, topk, toxicity
from ledgerflow.sources.tables import read_table


def op1_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files written and read back: place, length and checksum of each document."""
    return token_store.token_store_digest(read_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by word 3-gram similarity of 0.9 or more."""
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated runs that are not their first."""
    return sentences.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and disguised personal data of every document."""
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.packing_digest(read_table(spark, sf_dir, "documents"))


def op9_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings."""
    return suffix.suffix_digest(read_table(spark, sf_dir, "documents"))


def op10_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for every vector whose id is divisible by 50."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_novel_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of fixed forms and by novelty in every document."""
    return secrets.secrets_digest(read_table(spark, sf_dir, "documents"))


def op12_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_minimizer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return periodic.periodic_digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_factorization_machine, op2_bradley_terry, op3_token_store,
                              op4_jaccard_join, op5_sentence_spans, op6_simhash_windows, op7_deobfuscated_pii, op8_best_two_fit,
                              op9_suffix_intervals, op10_threshold_top_k, op11_novel_secrets,
                              op12_cover_tree_negatives, op13_minimizer_runs)
}

ORACLE: dict[str, str] = {
    "op10_threshold_top_k": """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5""",
    "op12_cover_tree_negatives": """
WITH ok AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                  CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
           FROM ok a JOIN ok c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3""",
}
