import datetime as dt
import math
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import BASE_TRIP
from strata import fixed_values as fv
from strata.operators import rollup
from strata.operators.deviation import deviation_from_mean, with_baseline
from strata.operators.rollup import Measure
from strata.plans import catalog

D = dt.datetime


def trip(day, hour, month=5, **changes):
    start = D(2023, month, day, hour)
    return {fv.PICKUP: start, fv.DROPOFF: start + dt.timedelta(minutes=20)} | changes


def test_metric_names_and_order(view):
    metrics = rollup.gold_by(view, "month").columns[1:]
    assert len(metrics) == 35
    assert metrics[:7] == [
        "total_trips", "total_passenger_count", "avg_passenger_count",
        "total_amount", "avg_total_amount", "max_total_amount", "min_total_amount",
    ]
    assert metrics[-4:] == [f"{stat}_travel_time_seconds" for stat in ("total", "avg", "max", "min")]


def test_all_metrics_against_plain_python(view):
    rows = [row.asDict() for row in view.collect()]
    groups = defaultdict(list)
    for row in rows:
        row["travel_time_seconds"] = int((row[fv.DROPOFF] - row[fv.PICKUP]).total_seconds())
        groups[row[fv.PICKUP].hour].append(row)
    result = {row.TIME_SLICE: row for row in rollup.gold_by(view, "hour").collect()}
    assert result.keys() == groups.keys()
    for hour, members in groups.items():
        assert result[hour].total_trips == len(members)
        for column in [*fv.MONEY_AND_DISTANCE, "travel_time_seconds"]:
            values = [row[column] for row in members if row[column] is not None]
            total = float(sum(Decimal(str(value)) for value in values))
            measure = Measure(column)
            assert result[hour][measure.metric("total")] == total
            assert result[hour][measure.metric("avg")] == total / len(values)
            assert result[hour][measure.metric("max")] == max(values)
            assert result[hour][measure.metric("min")] == min(values)


def test_nulls_are_skipped_per_column(trip_rows):
    rows = trip_rows({"airport_fee": 1.25}, {"airport_fee": None}, {"airport_fee": 0.0})
    row = rollup.gold_by(rows, "month").first()
    assert (row.total_trips, row.total_airport_fee, row.avg_airport_fee) == (3, 1.25, 0.625)
    row = rollup.gold_by(trip_rows({}, {}), "month").first()
    assert (row.total_airport_fee, row.avg_airport_fee, row.max_airport_fee) == (None, None, None)


def test_sums_do_not_depend_on_the_partitioning(view):
    results = {
        tuple(sorted(map(tuple, rollup.gold_by(view.repartition(n, "PULocationID"), "day").collect())))
        for n in (1, 3, 7)
    }
    assert len(results) == 1


def test_exact_sum_of_awkward_values(trip_rows):
    values = [0.1] * 10 + [-0.3, 1e12 + 0.25, -1e12, 123456.7891]
    rows = trip_rows(*[{"tip_amount": value} for value in values])
    expected = float(sum(Decimal(repr(value)) for value in values))
    assert rollup.gold_by(rows, "month").first().total_tip_amount == expected


@pytest.mark.parametrize(
    "values",
    [[0.00004] * 100_000, [1e19, 1.0], [1e300, -1e300, 0.5], [4e-30] * 1024, [2.0**62] * 8, [0.123456] * 1000],
)
def test_sums_of_any_size_are_kept(spark, values):
    rows = spark.createDataFrame([(value,) for value in values], "x double").repartition(3)
    row = rollup.summarise(rows, {"k": "1"}, [Measure("x")]).first()
    expected = math.fsum(values)
    assert row.total_x == pytest.approx(expected, rel=1e-14)
    assert row.avg_x == pytest.approx(expected / len(values), rel=1e-14)


def test_large_and_small_values_have_one_total_in_any_order(spark):
    values = [1e16, -1e16, 9e15 + 2, 3.5e17] * 5 + [-3.5e17, -9e15 - 2] * 5 + [0.3, 1.1e-12, 0.0000123] * 40
    expected = float(sum(Decimal(repr(value)) for value in values))
    for order in (values, sorted(values), sorted(values, key=abs), values[::-1]):
        rows = spark.createDataFrame([(value,) for value in order], "x double")
        for parts in (1, 5):
            assert rollup.summarise(rows.repartition(parts), {"k": "1"}, [Measure("x")]).first().total_x == expected


@pytest.mark.parametrize(
    "values, check",
    [
        ([1.0, math.nan], math.isnan),
        ([1.0, math.inf], lambda total: total == math.inf),
        ([1.0, -math.inf], lambda total: total == -math.inf),
        ([math.inf, -math.inf], math.isnan),
    ],
)
def test_values_that_are_not_finite_decide_the_total(trip_rows, values, check):
    rows = trip_rows(*[{"tip_amount": value} for value in values])
    assert check(rollup.gold_by(rows, "month").first().total_tip_amount)


def test_calendar_parts_pool_years_and_buckets_do_not(trip_rows):
    rows = trip_rows({}, {fv.PICKUP: D(2022, 3, 9, 8), fv.DROPOFF: D(2022, 3, 9, 9)})
    assert [row.TIME_SLICE for row in rollup.gold_by(rows, "month").collect()] == [3]
    buckets = rollup.gold_by(rows, "month", calendar="bucket")
    assert sorted(row.TIME_SLICE for row in buckets.collect()) == [D(2022, 3, 1), D(2023, 3, 1)]
    assert buckets.schema[fv.TIME_SLICE].dataType == rows.schema[fv.PICKUP].dataType


def test_unknown_slices_are_refused(view):
    for grain in ("week", "year", "Month"):
        with pytest.raises(ValueError, match="slice"):
            rollup.gold_by(view, grain)
    with pytest.raises(ValueError):
        rollup.gold_by(view, "day", calendar="lunar")


def test_cells_give_the_tables_of_a_direct_scan(view):
    cells = rollup.trip_cells(view)
    for grain in fv.GRAINS:
        direct, merged = rollup.gold_by(view, grain), rollup.gold_by_from_cells(cells, grain)
        assert direct.columns == merged.columns and direct.schema.simpleString() == merged.schema.simpleString()
        assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, merged.collect()))
    direct, merged = rollup.gold_focus(view, 5), rollup.gold_focus_from_cells(cells, 5)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, merged.collect()))


def test_every_grain_counts_every_trip(view):
    n = view.count()
    for grain in fv.GRAINS:
        assert rollup.gold_by(view, grain).agg(F.sum("total_trips")).first()[0] == n


def test_hour_mean_is_the_mean_of_day_means_unless_weighted(trip_rows):
    rows = trip_rows(trip(1, 0, passenger_count=4), *[trip(2, 0, passenger_count=1)] * 3)
    focus = rollup.gold_focus(rows, 5)
    assert rollup.hour_profile(focus).first().mean_passengers == 2.5
    assert rollup.hour_profile(focus).first().total_trips == 4
    assert rollup.hour_profile(focus, "trip_weighted").first().mean_passengers == 1.75
    with pytest.raises(ValueError):
        rollup.hour_profile(focus, "median")


def test_focus_takes_one_month(trip_rows):
    rows = trip_rows(trip(1, 0), trip(1, 0, month=4), BASE_TRIP)
    assert [row.MONTH_SLICE for row in rollup.gold_focus(rows, 5).collect()] == [5]


def test_scalar_baseline_equals_the_window(spark):
    rows = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, None)], "k int, x double")
    scalar = with_baseline(rows, "x", "mean", "deviation").orderBy("k").collect()
    window = deviation_from_mean(rows, "x", 4, "mean", "deviation").orderBy("k").collect()
    assert [tuple(row) for row in scalar] == [tuple(row) for row in window]
    assert [row.deviation for row in scalar] == [-10.0, 0.0, 10.0, None]


def test_gold_rows_come_in_the_order_of_time(spark, data, view):
    cells = rollup.trip_cells(view)
    names = ("gold_monthly", "gold_daily", "gold_hourly", "gold_monthly_display", "gold_daily_display",
             "gold_hourly_display", "gold_daily_buckets")
    tables = [catalog.queries()[name](spark, data) for name in names]
    for gold in tables + [rollup.gold_by_from_cells(cells, grain) for grain in fv.GRAINS]:
        slices = [row[0] for row in gold.collect()]
        assert slices == sorted(slices) and len(slices) > 4
    assert [gold.columns[0] for gold in tables[3:6]] == ["MONTH", "DAY", "HOUR"]
    for gold in (rollup.gold_focus(view, 5), rollup.gold_focus_from_cells(cells, 5)):
        keys = [tuple(row[:3]) for row in gold.collect()]
        assert keys == sorted(keys) and len(keys) > 100
