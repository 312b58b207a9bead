"""Time plans of this engine beside the step-by-step form of the same work, on the same stored rows.

The step-by-step forms are what the layer rules say when followed literally: one count per gate, one
scan of silver per gold table. Both sides give the same rows. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from strata import fixed_values as fv
from strata.operators import rollup
from strata.operators.quality import quality_ladder, trip_gates
from strata.plans import catalog
from strata.session import local_session, scratch_folder
from strata.sinks.tables import write_table
from strata.sources.tables import read_table


def noop(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def ladder_by_counts(bronze) -> None:
    remaining = bronze
    remaining.count()
    for gate in trip_gates(catalog.GATES):
        remaining = remaining.filter(gate.keeps)
        remaining.count()


def ladder_in_one_pass(bronze) -> None:
    quality_ladder(bronze, trip_gates(catalog.GATES)).collect()


def gold_by_scans(silver) -> None:
    for grain in fv.GRAINS:
        noop(rollup.gold_by(silver, grain))
    noop(rollup.gold_focus(silver, fv.FOCUS_MONTH))


def gold_by_cells(silver) -> None:
    spark = silver.sparkSession
    target = scratch_folder(spark, "cells")
    write_table(rollup.trip_cells(silver), target)
    cells = read_table(spark, target)
    for grain in fv.GRAINS:
        noop(rollup.gold_by_from_cells(cells, grain))
    noop(rollup.gold_focus_from_cells(cells, fv.FOCUS_MONTH))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "strata-bench-steps")
    spark.sparkContext.setLogLevel("ERROR")
    target = scratch_folder(spark, "trips")
    write_table(catalog.trips(spark, folder), target)
    stored = read_table(spark, target)

    timings = {}
    for work in (ladder_by_counts, ladder_in_one_pass, gold_by_scans, gold_by_cells):
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            work(stored)
            runs.append(time.perf_counter() - start)
        timings[work.__name__] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"unit": "sec", "rows": stored.count(), "work": timings}))
    spark.stop()


if __name__ == "__main__":
    main()
