"""Removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import fixed_values as fv

# Lineages that are listed by the driver and broadcast.
MOST_LISTED = 100_000


def drop_exact_duplicates(rows: DataFrame) -> DataFrame:
    """One of each set of rows equal in every column, lineage columns included.

    Tasks drop their own repeats before the shuffle, so a row that makes up a large part of the
    table leaves each task once.
    """
    return rows.dropDuplicates()


def drop_business_duplicates(
    rows: DataFrame, lineage: Sequence[str] = fv.AUDIT_FIELDS, most_listed: int = MOST_LISTED
) -> DataFrame:
    """One of each set of rows equal in every column outside ``lineage``.

    The survivor keeps the smallest lineage (compared column by column, NULL first), so the result does not
    depend on the order rows arrive in; repeats are again folded before the shuffle.

    Lineages are as many as the files, so they are listed, sorted and numbered first, from a scan of their
    columns alone. The smallest number is then a hash aggregate, without a sort on either side of the shuffle.
    With more than ``most_listed`` of them the smallest is taken of the columns themselves, by a sort.
    """
    carried = [name for name in rows.columns if name in lineage]
    keys = [name for name in rows.columns if name not in lineage]
    if not carried:
        return drop_exact_duplicates(rows)
    listed = rows.select(*carried).distinct().limit(most_listed + 1)
    known = listed.toArrow()
    if known.num_rows > most_listed:
        folded = rows.groupBy(*keys).agg(F.min(F.struct(*carried)).alias("_lineage"))
        return folded.select(
            *[F.col("_lineage")[name].alias(name) if name in carried else F.col(name) for name in rows.columns]
        )
    ordered = known.sort_by([(name, "ascending") for name in carried], null_placement="at_start")
    numbers = ordered.append_column("_number", pa.array(range(ordered.num_rows), pa.int64()))
    spark = rows.sparkSession
    numbered = F.broadcast(spark.createDataFrame(numbers).withColumnsRenamed({name: f"_{name}" for name in carried}))
    same = reduce(lambda one, other: one & other, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in carried])
    folded = rows.join(numbered, same).groupBy(*keys).agg(F.min("_number").alias("_least"))
    kept = folded.join(numbered, F.col("_least") == F.col("_number"))
    return kept.select(*[F.col(f"_{name}").alias(name) if name in carried else F.col(name) for name in rows.columns])


def duplicate_counts(rows: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
    """One row: rows_before, rows_removed, rows_remaining of the removal, in one pass."""
    keys = [name for name in rows.columns if name not in lineage]
    copies = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return copies.agg(
        total.alias("rows_before"),
        (total - F.count("*")).alias("rows_removed"),
        F.count("*").alias("rows_remaining"),
    )
