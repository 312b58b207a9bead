"""Calendar roll-ups.

One generator gives the metrics of every grain. It works in two steps: mergeable parts (sum, count,
maximum, minimum) and the finished metrics (total, average, maximum, minimum). Parts can be merged
again, so the month, day, hour and focus tables all come from one scan at the month/day/hour grain
("cells": at most 12 x 31 x 24 rows, however many trips there are).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.functions.calendar import (
    calendar_bucket,
    calendar_part,
    check_grain,
    three_parts,
    travel_seconds,
)
from strata.functions.numeric import DECIMALS, SUM_PARTS, joined_total, mean_of, sum_parts, summands

ALL_STATS = ("total", "avg", "max", "min")
ROWS = "_rows"
_FOLDS = {"count": "sum", "max": "max", "min": "min"}


@dataclass(frozen=True)
class Measure:
    """A column to summarise. Fractional values are summed by ``numeric.sum_parts`` with ticks of
    ``decimals`` places; None sums the column as it is, which is right for whole numbers."""

    column: str
    stats: tuple[str, ...] = ALL_STATS
    decimals: int | None = DECIMALS

    def metric(self, stat: str) -> str:
        if stat == "total" and self.column.startswith("total_"):
            return self.column
        return f"{stat}_{self.column}"

    def _part(self, kind: str) -> str:
        return f"_{kind}_{self.column}"

    def summands(self) -> dict[str, str]:
        """What the sums are made of, by kind: columns to compute before the rows are grouped."""
        return {} if self.decimals is None else summands(self.column, self.decimals)

    def parts(self) -> dict[str, str]:
        """Mergeable aggregates, by column name, over rows that have the summands."""
        column = self.column
        if self.decimals is None:
            sums = {"sum": f"sum({column})"}
        else:
            sums = sum_parts(column, self.decimals, {kind: self._part(kind) for kind in self.summands()})
        others = {"count": f"count({column})", "max": f"max({column})", "min": f"min({column})"}
        return {self._part(kind): part for kind, part in (sums | others).items()}

    def merged_parts(self) -> dict[str, str]:
        """The same parts over rows that hold parts."""
        return {name: f"{_FOLDS.get(name.split('_')[1], 'sum')}({name})" for name in self.parts()}

    def total(self) -> dict[str, str]:
        """The total over rows that hold parts, where it is not a part itself."""
        if self.decimals is None:
            return {}
        sums = {kind: self._part(kind) for kind in SUM_PARTS}
        return {self._part("sum"): joined_total(sums, self._part("min"), self._part("max"), self.decimals)}

    def metrics(self) -> dict[str, str]:
        """The finished metrics over rows that hold parts and totals."""
        low, high, count, total = (self._part(kind) for kind in ("min", "max", "count", "sum"))
        finished = {"total": total, "avg": mean_of(total, count), "max": high, "min": low}
        return {self.metric(stat): finished[stat] for stat in self.stats}


def trip_measures() -> list[Measure]:
    """The measures behind the 35 metrics of the gold tables (with the row count)."""
    return [
        Measure("passenger_count", stats=("total", "avg"), decimals=None),
        *[Measure(column) for column in fv.MONEY_AND_DISTANCE],
        Measure("travel_time_seconds", decimals=None),
    ]


def with_travel_time(trips: DataFrame) -> DataFrame:
    return trips.withColumn("travel_time_seconds", F.expr(travel_seconds()))


def _named(expressions: Mapping[str, str]) -> list[Column]:
    return [F.expr(text) for text in _texts(expressions)]


def _texts(expressions: Mapping[str, str]) -> list[str]:
    return [f"{text} AS `{name}`" for name, text in expressions.items()]


def part_aggregate(rows: DataFrame, keys: Mapping[str, str], measures: Sequence[Measure]) -> DataFrame:
    """Group by key expressions, keeping the mergeable parts: one partial and one final hash
    aggregate, whose shuffle carries one row per group and task."""
    parts = {ROWS: "count(*)"}
    prepared = {}
    for measure in measures:
        parts |= measure.parts()
        prepared |= {measure._part(kind): text for kind, text in measure.summands().items()}
    columns = dict.fromkeys(measure.column for measure in measures)
    rows = rows.selectExpr(*_texts(keys), *[f"`{name}`" for name in columns if name not in keys], *_texts(prepared))
    return rows.groupBy(*[f"`{name}`" for name in keys]).agg(*_named(parts))


def merge_parts(cells: DataFrame, keys: Mapping[str, str], measures: Sequence[Measure]) -> DataFrame:
    """Bring parts to a coarser key."""
    parts = {ROWS: f"sum({ROWS})"}
    for measure in measures:
        parts |= measure.merged_parts()
    return cells.groupBy(*_named(keys)).agg(*_named(parts))


def finish(
    parts: DataFrame, keys: Sequence[str], measures: Sequence[Measure], count_name: str = "total_trips"
) -> DataFrame:
    totals, metrics = {}, {count_name: ROWS}
    for measure in measures:
        totals |= measure.total()
        metrics |= measure.metrics()
    return parts.selectExpr("*", *_texts(totals)).selectExpr(*keys, *_texts(metrics))


def summarise(
    rows: DataFrame, keys: Mapping[str, str], measures: Sequence[Measure], count_name: str = "total_trips"
) -> DataFrame:
    """Group by key expressions and finish the metrics."""
    return finish(part_aggregate(rows, keys, measures), list(keys), measures, count_name)


def rollup(
    rows: DataFrame,
    grain: str,
    ts: str,
    measures: Sequence[Measure],
    calendar: str = "part",
    count_name: str = "total_trips",
) -> DataFrame:
    """Metrics by TIME_SLICE for any table. ``calendar="part"`` pools equal months, days of month
    or hours; ``calendar="bucket"`` keeps each month, day or hour apart."""
    if calendar == "part":
        key = calendar_part(grain, ts)
    elif calendar == "bucket":
        key = calendar_bucket(grain, ts, rows.schema[ts].dataType.simpleString())
    else:
        raise ValueError(f"unknown calendar: {calendar}")
    return summarise(rows, {fv.TIME_SLICE: key}, measures, count_name)


def gold_by(trips: DataFrame, grain: str, calendar: str = "part") -> DataFrame:
    """The monthly, daily or hourly gold table straight from trips, in the order of time. Pooled slices are at
    most 31 rows, sorted in one task; buckets are as many as the data has."""
    slices = rollup(with_travel_time(trips), grain, fv.PICKUP, trip_measures(), calendar)
    if calendar == "part":
        return slices.coalesce(1).sortWithinPartitions(fv.TIME_SLICE)
    return slices.orderBy(fv.TIME_SLICE)


def gold_focus(trips: DataFrame, month: int) -> DataFrame:
    """The month/day/hour gold table of one month, straight from trips, in the order of time."""
    only = with_travel_time(trips.filter(F.month(fv.PICKUP) == month))
    parts = three_parts(fv.PICKUP)
    return summarise(only, parts, trip_measures()).coalesce(1).sortWithinPartitions(*parts)


def trip_cells(trips: DataFrame) -> DataFrame:
    """Mergeable parts of all metrics by month, day and hour: the one scan behind all gold tables."""
    return part_aggregate(with_travel_time(trips), three_parts(fv.PICKUP), trip_measures())


def gold_by_from_cells(cells: DataFrame, grain: str) -> DataFrame:
    key = {"month": fv.MONTH_SLICE, "day": fv.DAY_SLICE, "hour": fv.HOUR_SLICE}[check_grain(grain)]
    measures = trip_measures()
    merged = merge_parts(cells, {fv.TIME_SLICE: key}, measures)
    return finish(merged, [fv.TIME_SLICE], measures).coalesce(1).sortWithinPartitions(fv.TIME_SLICE)


def gold_focus_from_cells(cells: DataFrame, month: int) -> DataFrame:
    keys = [fv.MONTH_SLICE, fv.DAY_SLICE, fv.HOUR_SLICE]
    return finish(cells.filter(F.col(fv.MONTH_SLICE) == month), keys, trip_measures()).coalesce(1).sortWithinPartitions(*keys)


def hour_profile(focus: DataFrame, hour_mean: str = "mean_of_means") -> DataFrame:
    """Hour rows from the (day, hour) rows of the focus table: mean passengers and trip volume."""
    if hour_mean == "mean_of_means":
        mean = F.avg("avg_passenger_count")
    elif hour_mean == "trip_weighted":
        mean = F.sum("total_passenger_count").cast("double") / F.sum("total_trips")
    else:
        raise ValueError(f"unknown hour_mean: {hour_mean}")
    return focus.groupBy(fv.HOUR_SLICE).agg(
        mean.alias("mean_passengers"), F.sum("total_trips").alias("total_trips")
    )
