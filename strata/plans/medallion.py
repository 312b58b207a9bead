"""The whole run: landing folder to bronze, silver, gold and the two reports."""

from __future__ import annotations

import dataclasses
import datetime as dt
import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.config import RunOptions
from strata.operators.harmonize import cast_losses, harmonize, schema_drift, schema_matrix, stack
from strata.operators.quality import first_failed, gate_counts, ladder_of_counts, quality_ladder, trip_gates
from strata.operators.rollup import gold_by_from_cells, gold_focus_from_cells, trip_cells
from strata.plans.reports import hourly_density, monthly_revenue
from strata.plans.run_store import RunStore, fingerprint
from strata.plans.silver import silver_rows
from strata.session import partitions_for
from strata.sinks.tables import audit_stamp, cluster_rows, with_pickup_date
from strata.sources.landing import field_rows, listing_fingerprint, read_footers, read_landing, unreadable_files


def run_medallion(
    spark: SparkSession, landing: str | None, store: str, options: RunOptions = RunOptions()
) -> dict[str, DataFrame]:
    """Write every layer below ``store`` (a folder or a catalog database) and return them.

    Each stage reads what the stage before stored, so a lost executor costs the tasks it ran and never an
    earlier layer, and is recorded when it is done: the same run again goes on behind the last recorded stage.
    A landing folder whose names, sizes and times are unchanged is not read again; with ``landing`` None the
    run starts from the bronze layer stored last, and the landing layers are not returned.

    The gates are counted while bronze is written, so bronze is scanned once, for silver, and silver once
    for all gold tables.
    """
    kept = RunStore(spark, store)
    at = options.ingested_at or dt.datetime.now()
    rules = fingerprint(dataclasses.replace(options, ingested_at=None))

    def stamped(rows: DataFrame, file_name: str | None = None) -> DataFrame:
        return audit_stamp(rows, options.audit_system, options.audit_script, at, file_name)

    if landing is None:
        layers, mark = {}, kept.latest("bronze")
        if mark is None:
            raise ValueError(f"no bronze layer is recorded in {store}")
        layers["bronze"] = kept.done("bronze", mark)
    else:
        mark = fingerprint(landing, listing_fingerprint(spark, landing), options.audit_system, options.audit_script)
        layers = _land(kept, landing, mark, options, stamped)
    bronze = layers["bronze"]

    mark = fingerprint(mark, rules)
    # Counted with the same rules while bronze was written, or now from what is stored.
    ladder = kept.layer("gate_ladder", mark, lambda: quality_ladder(bronze, trip_gates(options.gates)))

    def silver() -> DataFrame:
        return cluster_rows(with_pickup_date(stamped(silver_rows(bronze, options))), [fv.PICKUP], files)

    # The ladder tells how many rows reach the shuffles of the silver layer. Lineage is kept: silver
    # rows still name the file they came from.
    passed = ladder.agg(F.min("rows_remaining")).first()[0]
    files = max(1, math.ceil(passed / options.silver_rows_per_file))
    with partitions_for(spark, passed, options.silver_rows_per_file):
        layers["silver"] = kept.layer("silver", mark, silver)
    layers["quality_ladder"] = kept.layer(
        "quality_ladder", mark,
        lambda: with_dedup_step(ladder, layers["silver"]).coalesce(1).sortWithinPartitions("step"),
    )

    cells = layers["trip_cells"] = kept.layer("trip_cells", mark, lambda: trip_cells(layers["silver"]))
    gold = {
        "gold_monthly": (gold_by_from_cells(cells, "month"), [fv.TIME_SLICE]),
        "gold_daily": (gold_by_from_cells(cells, "day"), [fv.TIME_SLICE]),
        "gold_hourly": (gold_by_from_cells(cells, "hour"), [fv.TIME_SLICE]),
        "gold_focus": (gold_focus_from_cells(cells, options.focus_month), [fv.DAY_SLICE, fv.HOUR_SLICE]),
    }
    for name, (rows, order) in gold.items():
        # At most 744 rows: one sorted file.
        layers[name] = kept.layer(
            name, mark, lambda: stamped(rows, name).coalesce(1).sortWithinPartitions(*order)
        )

    layers["report_monthly_revenue"] = monthly_revenue(layers["gold_monthly"])
    layers["report_hourly_density"] = hourly_density(layers["gold_focus"], options.hour_mean)
    return layers


def _land(kept: RunStore, landing: str, mark: str, options: RunOptions, stamped) -> dict[str, DataFrame]:
    """The layers made from the landing folder. While bronze is written its rows are counted by the first gate they
    fail; the counts are stored as the ladder if they account for every row that was stored."""
    spark = kept.spark
    layers: dict[str, DataFrame] = {}
    footers = kept.layer("landing_footers", mark, lambda: read_footers(spark, landing))
    layers["landing_fields"] = field_rows(footers)
    layers["schema_matrix"] = schema_matrix(layers["landing_fields"])
    layers["schema_drift"] = schema_drift(layers["landing_fields"])
    layers["unreadable_files"] = unreadable_files(footers)

    def landed() -> list[DataFrame]:
        return read_landing(spark, landing, footers)

    layers["cast_losses"] = kept.layer(
        "cast_losses", mark, lambda: stack([cast_losses(rows) for rows in landed()])
    )
    gates, seen = trip_gates(options.gates), Observation("gates")

    def bronze() -> DataFrame:
        rows = stamped(stack([harmonize(rows) for rows in landed()]))
        labelled = rows.withColumn("_gate", F.expr(first_failed(gates)))
        return labelled.observe(seen, *gate_counts(gates, "_gate")).drop("_gate")

    fresh = kept.done("bronze", mark) is None
    layers["bronze"] = kept.layer("bronze", mark, bronze)
    if fresh:
        counts = seen.get
        # A task that ran twice would be counted twice. The number of stored rows is in the footers.
        if sum(counts.values()) == layers["bronze"].count():
            rules = fingerprint(mark, fingerprint(dataclasses.replace(options, ingested_at=None)))
            kept.layer("gate_ladder", rules, lambda: ladder_of_counts(spark, gates, counts))
    return layers


def with_dedup_step(ladder: DataFrame, silver: DataFrame) -> DataFrame:
    """The ladder with duplicate removal as its last step."""
    last = ladder.agg(F.max("step").alias("gates"), F.min("rows_remaining").alias("before"))
    remaining = silver.agg(F.count("*").alias("n")).scalar()
    step = last.select(
        (F.col("gates") + 1).alias("step"),
        F.lit("duplicates").alias("gate"),
        F.col("before").alias("rows_before"),
        (F.col("before") - remaining).alias("rows_removed"),
        F.lit(0).cast("bigint").alias("rows_null"),
        remaining.alias("rows_remaining"),
    )
    return ladder.unionByName(step)
