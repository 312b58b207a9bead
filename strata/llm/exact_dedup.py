"""Exact duplicate removal with a split for heavy hitters.

The text of a row is reduced to its SHA-256 once, and the digests are written. A Misra-Gries pass
(``freqItems``) over them gives at most ``1 / support`` suspects, among them every digest with more than
``support`` of all rows; their exact counts decide which are winners. The winners, a table whose size
``support`` bounds, are broadcast, and rows with those digests never reach a shuffle. The other digests
are shuffled: none of them has more than ``support`` of the rows.

Defined results: a null text counts as empty. Of rows with equal texts the one with the largest doc_id
stays (nulls are smallest; of rows that also share the doc_id, exactly one). An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

SUPPORT = 0.001


def text_digest():
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = docs.select(
        "doc_id",
        text_digest().alias("text_sha256"),
        # Written with the digest, so it stays the same whatever is computed again later.
        F.monotonically_increasing_id().alias("row_no"),
    )
    rows = staged(digests, "digests")
    hot = winners(rows, support)
    held = F.broadcast(hot)
    rest = rows.join(held.select("text_sha256"), "text_sha256", "left_anti")
    answer = (
        F.col("doc_id"),
        F.col("keep.doc_id").alias("keep_id"),
        F.col("group_size"),
        (F.col("row_no") == F.col("keep.row_no")).alias("kept"),
        F.col("text_sha256"),
    )
    return (
        rows.join(held, "text_sha256")
        .select(*answer)
        .unionByName(rest.join(_groups(rest), "text_sha256").select(*answer))
    )


def winners(rows: DataFrame, support: float) -> DataFrame:
    """The groups with more than ``support`` of all rows: at most ``1 / support`` of them."""
    suspects = rows.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    counted = _groups(rows.join(F.broadcast(suspects), "text_sha256", "left_semi"))
    everything = rows.agg(F.count("*").alias("n")).scalar()
    return counted.filter(F.col("group_size") > everything * F.lit(support))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("text_sha256").agg(
        F.max(F.struct("doc_id", "row_no")).alias("keep"), F.count("*").alias("group_size")
    )


def drop_exact(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows that agree in doc_id and text are
    one document, of which any one row stays."""
    kept = exact_groups(docs, support).filter("kept").select(
        F.col("keep_id").alias("__strata_keep_id"), F.col("text_sha256").alias("__strata_digest"), "group_size"
    )
    kept = staged(kept, "kept")
    same = (F.col("doc_id").eqNullSafe(F.col("__strata_keep_id"))) & (text_digest() == F.col("__strata_digest"))
    # A group of one row has no second row of its doc_id; the others are a small part of the table.
    single = docs.join(kept.filter("group_size = 1"), same, "left_semi")
    several = docs.join(kept.filter("group_size > 1"), same, "left_semi")
    first = several.withColumn("__strata_digest", text_digest()).dropDuplicates(["doc_id", "__strata_digest"])
    return single.unionByName(first.drop("__strata_digest"))
