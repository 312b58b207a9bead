"""The shape of the physical plans: what is scanned, shuffled and gathered."""

import datetime as dt
import re

import pytest

from conftest import explained
from strata import fixed_values as fv
from strata.operators import rollup
from strata.operators.deviation import with_baseline
from strata.operators.quality import apply_gates, quality_ladder, trip_gates
from strata.plans import catalog
from strata.session import scratch_folder
from strata.sinks.tables import write_table
from strata.sources.tables import read_table


def exchanges(plan: str) -> list[str]:
    return re.findall(r"^Arguments: (.*ENSURE_REQUIREMENTS.*|.*REPARTITION.*)$", plan, re.M)


@pytest.fixture(scope="module")
def stored(spark, view):
    target = scratch_folder(spark, "trips")
    write_table(view, target)
    return read_table(spark, target)


def test_gates_on_a_stored_table_reach_the_scan(stored):
    plan = explained(apply_gates(stored, trip_gates()))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for column in ("passenger_count", "fare_amount", "total_amount", "trip_distance", "RatecodeID",
                   "PULocationID", "DOLocationID", fv.PICKUP):
        assert re.search(rf"(GreaterThan|GreaterThanOrEqual)\({column},", pushed), column


def test_a_rollup_reads_its_columns_once_and_shuffles_partial_sums(stored):
    plan = explained(rollup.gold_by(stored, "month"))
    assert plan.count("ReadSchema") == 1 and len(exchanges(plan)) == 1
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "VendorID" not in schema and "PULocationID" not in schema
    tree = plan.split("(1)")[0]
    assert "partial_sum" in plan and "SortAggregate" not in tree
    # The one sort is of the finished slices, at most 31 rows in one task.
    assert tree.count("Sort") == 1 and tree.index("Sort") < tree.index("Coalesce") < tree.index("HashAggregate")


def test_sums_of_decimals_skip_rows_that_count_in_ticks(stored):
    plan = explained(rollup.gold_by(stored, "hour"))
    partial = max(re.findall(r"^Functions .*partial_sum.*$", plan, re.M), key=len)
    decimals = re.findall(r"partial_sum\(cast\(\(?_number_\w+#\d+ (?:as|-)", partial)
    filtered = re.findall(r"FILTER \(WHERE isnotnull\(_number_(\w+)#", partial)
    assert len(decimals) == len(filtered) and sorted(filtered) == sorted(2 * list(fv.MONEY_AND_DISTANCE))


def test_the_ladder_is_one_scan_of_the_gate_columns(stored):
    plan = explained(quality_ladder(stored, trip_gates()))
    assert plan.count("ReadSchema") == 1
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "tip_amount" not in schema and "airport_fee" not in schema


def test_cells_are_computed_once_for_all_grains(spark, data):
    result = catalog.gold_from_cells(spark, data)
    result.collect()
    final = explained(result).split("== Initial Plan")[0]
    tree = final.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("ReusedExchange") == 2


def test_the_baseline_of_a_large_table_is_not_gathered(stored):
    plan = explained(with_baseline(stored.select("VendorID", "total_amount"), "total_amount", "m", "d"))
    main = plan.split("Subquery")[0]
    assert "Window" not in plan and "SinglePartition" not in main and "Cartesian" not in plan
    assert "NestedLoop" not in plan


def test_no_query_uses_a_cross_join_or_row_by_row_python(spark, data):
    for name, query in catalog.queries().items():
        plan = explained(query(spark, data), "simple")
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert operator not in plan, (name, operator)


def test_a_range_on_ship_days_is_pushed_to_the_given_table(spark, data):
    plan = explained(catalog.silver_trips(spark, data))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_focus_month_of_stored_silver_keeps_plain_columns(stored):
    plan = explained(rollup.gold_focus(stored.filter(f"{fv.PICKUP} < DATE '{dt.date(1997, 6, 1)}'"), 5))
    assert plan.count("ReadSchema") == 1 and f"LessThan({fv.PICKUP}" in plan
