"""Comparison of each row with the mean of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.numeric import DECIMALS, exact_mean


def over_all(value: Column) -> Column:
    """Mean over the whole table as a window. The window gathers the table in one task, so it is
    for calendar summaries (at most 31 rows); ``with_baseline`` is for tables of any size."""
    return F.avg(value).over(Window.partitionBy())


def deviation_from_mean(summary: DataFrame, value: str, digits: int, mean: str, deviation: str) -> DataFrame:
    """Add the mean of a calendar summary and each row's deviation from the unrounded mean."""
    baseline = over_all(F.col(value))
    return summary.withColumns(
        {mean: F.round(baseline, digits), deviation: F.round(F.col(value) - baseline, digits)}
    )


def with_baseline(
    rows: DataFrame, value: str, mean: str, deviation: str, decimals: int = DECIMALS
) -> DataFrame:
    """Add the mean of ``value`` over all rows and the deviation from it, both unrounded.

    The mean is a scalar subquery: one aggregate over the pruned column, whose single value is then
    a constant of the second scan. Nothing is gathered in one task and no rows are shuffled.
    """
    overall = rows.agg(F.expr(exact_mean(value, decimals))).scalar()
    return rows.withColumn(mean, overall).withColumn(deviation, F.col(value) - F.col(mean))
