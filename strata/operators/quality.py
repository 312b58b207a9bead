"""Quality gates: ordered row filters, and a count of what each one removes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.config import GateOptions
from strata.functions.calendar import travel_seconds


@dataclass(frozen=True)
class Gate:
    """A named SQL predicate. A row passes where it is true; false and NULL both fail."""

    name: str
    keeps: str


def trip_gates(options: GateOptions = GateOptions()) -> list[Gate]:
    """The eleven gates of the silver layer, in the order they are applied.

    Bounds are typed literals and columns are left bare, so on a stored table every gate that compares
    one column with constants is pushed to the Parquet scan.
    """
    pickup, dropoff = fv.PICKUP, fv.DROPOFF

    # A date compares as its midnight, for timestamps with and without time zone alike.
    if options.duration_rule == "calendar_day":
        not_too_long = f"{dropoff} <= date_add({pickup}, 1)"
    else:
        not_too_long = f"{travel_seconds()} <= 86400"

    if options.window_end == "inclusive_midnight":
        in_window = f"{pickup} BETWEEN DATE '{options.first_day}' AND DATE '{options.last_day}'"
    else:
        day_after = options.last_day + dt.timedelta(days=1)
        in_window = f"{pickup} >= DATE '{options.first_day}' AND {pickup} < DATE '{day_after}'"

    (low_rate, high_rate), (low_zone, high_zone) = options.rate_codes, options.zones
    return [
        Gate("passenger", "passenger_count > 0"),
        Gate("fare", "fare_amount > 0"),
        Gate("total", "total_amount > 0"),
        Gate("total_covers_fare", "total_amount >= fare_amount"),
        Gate("distance", "trip_distance > 0"),
        Gate("rate_code", f"RatecodeID BETWEEN {low_rate} AND {high_rate}"),
        Gate("pickup_zone", f"PULocationID BETWEEN {low_zone} AND {high_zone}"),
        Gate("dropoff_zone", f"DOLocationID BETWEEN {low_zone} AND {high_zone}"),
        Gate("chronology", f"{pickup} < {dropoff}"),
        Gate("duration", not_too_long),
        Gate("pickup_window", in_window),
    ]


def apply_gates(rows: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """Rows that pass every gate, as one conjunction."""
    return rows.filter(" AND ".join(f"({gate.keeps})" for gate in gates)) if gates else rows


def month_of(rows: DataFrame, month: int, ts: str = fv.PICKUP) -> DataFrame:
    """Rows whose ``ts`` falls in a month of the year, in any year."""
    return rows.filter(F.month(ts) == month)


def first_failed(gates: Sequence[Gate]) -> str:
    """The number of the first gate a row fails, negative where that gate met a NULL; one more than there
    are gates for a row that passes all."""
    branches = " ".join(
        f"WHEN ({gate.keeps}) IS NULL THEN {-step} WHEN NOT ({gate.keeps}) THEN {step}"
        for step, gate in enumerate(gates, 1)
    )
    return f"CASE {branches} ELSE {len(gates) + 1} END"


def _labels(gates: Sequence[Gate]) -> list[int]:
    return [*range(-len(gates), 0), *range(1, len(gates) + 2)]


def gate_counts(gates: Sequence[Gate], label: str) -> list[Column]:
    """How many rows have each label of ``first_failed`` in a column, as aggregates to observe while rows are
    written."""
    return [F.count_if(F.col(label) == value).alias(f"label_{value}") for value in _labels(gates)]


def ladder_of_counts(spark: SparkSession, gates: Sequence[Gate], counts: Mapping[str, int]) -> DataFrame:
    """The ladder from counts by label."""
    rows = [(value, int(counts[f"label_{value}"])) for value in _labels(gates)]
    return _ladder(spark.createDataFrame(rows, "label int, n bigint").coalesce(1), gates)


def quality_ladder(rows: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """What every gate removes when the gates run in order, from one pass over ``rows``.

    Columns: step, gate, rows_before, rows_removed, rows_null (the part of rows_removed for which
    the gate could not decide because of a NULL), rows_remaining.

    Each row is labelled with the first gate it fails, and only the labels are counted: a task hands on at
    most two counts per gate. The counts are an ordinary aggregate, so a task that runs twice is counted once.
    """
    labelled = rows.select(F.expr(first_failed(gates)).alias("label"))
    return _ladder(labelled.groupBy("label").agg(F.count("*").alias("n")), gates)


def _ladder(counted: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    def sum_where(condition: str) -> str:
        return f"coalesce(sum(n) FILTER (WHERE {condition}), 0L)"

    steps = ", ".join(
        f"named_struct('step', {step}, 'gate', '{gate.name}',"
        f" 'rows_before', {sum_where(f'abs(label) >= {step}')},"
        f" 'rows_removed', {sum_where(f'abs(label) = {step}')},"
        f" 'rows_null', {sum_where(f'label = {-step}')},"
        f" 'rows_remaining', {sum_where(f'abs(label) > {step}')})"
        for step, gate in enumerate(gates, 1)
    )
    return counted.agg(F.expr(f"array({steps})").alias("steps")).selectExpr("inline(steps)")
