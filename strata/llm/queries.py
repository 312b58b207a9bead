"""The operators as named queries over the given tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    alignment,
    ann,
    exact_dedup,
    hard_negatives,
    minhash,
    mixing,
    ngram_join,
    ppm,
    quality,
    sentencepiece,
    token_count,
    toxicity,
    url_filter,
)
from strata.llm.common import crc_remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(table(spark, folder, "documents"))


def exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.listed_urls(pages))


def near_groups(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(table(spark, folder, "documents"), words=2, percent=80)


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scores = toxicity.score(documents, labels, "toxic", quality.fold())
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(table(spark, folder, "documents"), crc_remainder("doc_id", 7) == 2)


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece.encode(table(spark, folder, "documents"))


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scores = quality.score(documents, labels, "quality", quality.fold())
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def ngram_groups(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, folder, "documents"), words=5, percent=80)


def hard_negative_rows(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def alignments(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": token_counts,
        "op2_exact_dedup": exact_groups,
        "op3_source_mix": source_mix,
        "op4_url_filter": url_verdicts,
        "op5_minhash": near_groups,
        "op6_neighbours": neighbours,
        "op7_toxicity": toxicity_scores,
        "op8_lm_score": lm_scores,
        "op9_sentencepiece": pieces,
        "op10_quality": quality_scores,
        "op11_ngram_join": ngram_groups,
        "op12_hard_negatives": hard_negative_rows,
        "op13_alignment": alignments,
    }
