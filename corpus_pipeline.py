"""A corpus pipeline of five stages: quality, exact copies, near copies, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept. All but the last
return the columns of documents. No stage is expressible as SQL over the tables as a whole (the first is a
fitted classifier), so there is none; tests compare the stages with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, minhash, mixing, quality, sentencepiece
from strata.llm.common import staged, table

LEAST_QUALITY = 0.3


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote does not reject."""
    labels = table(spark, sf_dir, "labels")
    return quality.keep_good(docs, labels, "quality", quality.fold(), LEAST_QUALITY)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest doc_id."""
    return minhash.drop_near(docs, words=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a document once for each pass in which it is taken."""
    return mixing.mixture(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, round_trip of each document of the mix."""
    return sentencepiece.encode(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("source_mix", mixed_sources),
    ("sentencepiece", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
