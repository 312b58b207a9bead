import dataclasses
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import BASE_TRIP, TRIP_DDL
from strata.config import GateOptions
from strata.operators.quality import Gate, apply_gates, month_of, quality_ladder, trip_gates

D = dt.datetime
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def at(pickup, dropoff):
    return {PICKUP: pickup, DROPOFF: dropoff}


CASES = [
    ("base", {}, True),
    ("no passengers", {"passenger_count": 0}, False),
    ("negative passengers", {"passenger_count": -1}, False),
    ("unknown passengers", {"passenger_count": None}, False),
    ("no fare", {"fare_amount": 0.0}, False),
    ("unknown fare", {"fare_amount": None}, False),
    ("no total", {"total_amount": 0.0}, False),
    ("total equals fare", {"total_amount": 10.0}, True),
    ("total below fare", {"total_amount": 9.99}, False),
    ("no distance", {"trip_distance": 0.0}, False),
    ("rate 1", {"RatecodeID": 1}, True),
    ("rate 6", {"RatecodeID": 6}, True),
    ("rate 7", {"RatecodeID": 7}, False),
    ("rate 99", {"RatecodeID": 99}, False),
    ("unknown rate", {"RatecodeID": None}, False),
    ("pickup zone 0", {"PULocationID": 0}, False),
    ("pickup zone 263", {"PULocationID": 263}, True),
    ("pickup zone 264", {"PULocationID": 264}, False),
    ("dropoff zone 0", {"DOLocationID": 0}, False),
    ("dropoff zone 1", {"DOLocationID": 1}, True),
    ("dropoff zone 264", {"DOLocationID": 264}, False),
    ("no time passes", at(D(2023, 3, 1, 10), D(2023, 3, 1, 10)), False),
    ("time runs back", at(D(2023, 3, 1, 10), D(2023, 3, 1, 9)), False),
    ("crosses midnight", at(D(2023, 3, 1, 23, 50), D(2023, 3, 2, 0, 10)), False),
    ("ends at midnight", at(D(2023, 3, 1, 10), D(2023, 3, 2)), True),
    ("first moment", at(D(2023, 1, 1), D(2023, 1, 1, 0, 5)), True),
    ("before the first", at(D(2022, 12, 31, 23, 59, 59), D(2023, 1, 1)), False),
    ("last moment", at(D(2023, 5, 31), D(2023, 5, 31, 0, 5)), True),
    ("after the last", at(D(2023, 5, 31, 0, 0, 1), D(2023, 5, 31, 0, 5)), False),
]


@pytest.fixture(scope="module")
def kept(spark):
    rows = [(name, *(BASE_TRIP | change).values()) for name, change, _ in CASES]
    frame = spark.createDataFrame(rows, f"name string, {TRIP_DDL}").cache()

    def names(options=GateOptions()):
        return {row.name for row in apply_gates(frame, trip_gates(options)).select("name").collect()}

    return names


def test_every_case_is_kept_or_dropped_as_coded(kept):
    assert kept() == {name for name, _, keep in CASES if keep}


def test_timestamps_with_time_zone_give_the_same_answers(spark):
    ddl = TRIP_DDL.replace("timestamp_ntz", "timestamp")
    rows = [(name, *(BASE_TRIP | change).values()) for name, change, _ in CASES]
    frame = spark.createDataFrame(rows, f"name string, {TRIP_DDL}")
    zoned = frame.withColumns({c: frame[c].cast("timestamp") for c in (PICKUP, DROPOFF)})
    assert ddl.split(",")[1].strip() == f"{PICKUP} timestamp"
    names = {row.name for row in apply_gates(zoned, trip_gates()).select("name").collect()}
    assert names == {name for name, _, keep in CASES if keep}


def test_worded_rules_are_options(kept):
    coded = kept()
    assert kept(GateOptions(duration_rule="elapsed_24h")) - coded == {"crosses midnight"}
    assert kept(GateOptions(window_end="exclusive_next_day")) - coded == {"after the last"}


def test_unknown_options_are_refused():
    with pytest.raises(ValueError):
        GateOptions(duration_rule="about_a_day")
    with pytest.raises(ValueError):
        dataclasses.replace(GateOptions(), window_end="later")


def test_month_filter_takes_the_month_of_every_year(trip_rows):
    rows = trip_rows(at(D(2022, 5, 1), D(2022, 5, 1, 1)), at(D(2023, 5, 9), D(2023, 5, 9, 1)), {})
    assert month_of(rows, 5).count() == 2


def test_ladder_of_the_view(view):
    gates = trip_gates(GateOptions(first_day=dt.date(1997, 1, 1), last_day=dt.date(1997, 5, 31)))
    steps = quality_ladder(view, gates).orderBy("step").collect()
    assert [row.gate for row in steps] == [gate.name for gate in gates]
    assert [row.rows_remaining for row in steps] == [
        5129, 5045, 5045, 4572, 3879, 3338, 3338, 3320, 3250, 3038, 191,
    ]
    for before, after in zip(steps, steps[1:]):
        assert before.rows_remaining == after.rows_before
    assert steps[-1].rows_remaining == apply_gates(view, gates).count()


GATES = [Gate("a", "a > 0"), Gate("ab", "a >= b"), Gate("c", "c BETWEEN 1 AND 3")]
value = st.one_of(st.none(), st.integers(-2, 5))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(value, value, value), max_size=25))
def test_one_pass_equals_filters_in_sequence(spark, rows):
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    steps = quality_ladder(frame, GATES).orderBy("step").collect()
    remaining = frame
    for gate, step in zip(GATES, steps):
        before = remaining.count()
        nulls = remaining.filter(f"({gate.keeps}) IS NULL").count()
        remaining = remaining.filter(gate.keeps)
        after = remaining.count()
        assert (step.gate, step.rows_before, step.rows_removed, step.rows_null, step.rows_remaining) == (
            gate.name, before, before - after, nulls, after,
        )


def test_ladder_of_an_empty_table(spark):
    steps = quality_ladder(spark.createDataFrame([], "a int, b int, c int"), GATES).collect()
    assert [(row.rows_before, row.rows_remaining) for row in steps] == [(0, 0)] * 3
