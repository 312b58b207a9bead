"""Named queries over the given tables: one per operator or report."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.config import GateOptions, RunOptions
from strata.functions.calendar import three_parts, travel_seconds
from strata.functions.labels import label_of, sign_status
from strata.operators import dedup, harmonize, quality, rollup
from strata.operators.deviation import deviation_from_mean, with_baseline
from strata.operators.rollup import Measure
from strata.plans import landing_drop, reports
from strata.plans.medallion import run_medallion
from strata.plans.silver import silver_rows
from strata.session import scratch_folder
from strata.sinks import tables as sinks
from strata.sources import landing
from strata.sources import tables as sources
from strata.sources.trip_view import (
    VIEW_FIRST_DAY,
    VIEW_LAST_DAY,
    read_given_table,
    trip_view,
    trips_picked_up,
)

Query = Callable[[SparkSession, str], DataFrame]

GATES = GateOptions(first_day=VIEW_FIRST_DAY, last_day=VIEW_LAST_DAY)
AS_CODED = RunOptions(gates=GATES)
AS_WORDED = RunOptions(
    gates=dataclasses.replace(GATES, duration_rule="elapsed_24h", window_end="exclusive_next_day"),
    dedup="business",
    hour_mean="trip_weighted",
)
SQL_FOLDER = Path(__file__).parent / "sql"
_STAMP = ("spark_medallion", "catalog", dt.datetime(2026, 1, 1))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_given_table(spark, folder, name)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return trip_view(table(spark, folder, "lineitem"))


def silver(spark: SparkSession, folder: str, options: RunOptions = AS_CODED) -> DataFrame:
    """Silver rows. The window gate keeps no pickup after its last day, so only those days are read."""
    day_after = options.gates.last_day + dt.timedelta(days=1)
    lineitem = table(spark, folder, "lineitem")
    return silver_rows(trips_picked_up(lineitem, options.gates.first_day, day_after), options)


# Gates


def one_gate(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        gates = [gate for gate in quality.trip_gates(GATES) if gate.name == name]
        return quality.apply_gates(trips(spark, folder), gates)

    return query


def ladder(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_ladder(trips(spark, folder), quality.trip_gates(GATES))


def ladder_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    holes = trips(spark, folder).withColumns(
        {
            "passenger_count": F.nullif("passenger_count", F.lit(3)),
            "RatecodeID": F.nullif("RatecodeID", F.lit(5)),
            "PULocationID": F.nullif("PULocationID", F.lit(100)),
        }
    )
    return quality.quality_ladder(holes, quality.trip_gates(GATES))


def focus_month_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.month_of(trips(spark, folder), fv.FOCUS_MONTH)


def late_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Trips in the window by pickup month and by the file they came in, which may be a later one."""
    day_after = VIEW_LAST_DAY + dt.timedelta(days=1)
    published = trips_picked_up(table(spark, folder, "lineitem"), VIEW_FIRST_DAY, day_after)
    in_window = [gate for gate in quality.trip_gates(GATES) if gate.name == "pickup_window"]
    return (
        quality.apply_gates(published, in_window)
        .groupBy(
            F.month(landing_drop.published_in()).alias("file_month"), F.month(fv.PICKUP).alias("pickup_month")
        )
        .agg(F.count("*").alias("trips"))
        .withColumn("is_late", F.col("file_month") > F.col("pickup_month"))
    )


# Duplicates


def stacked_with_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with repeats inside one file and across two files."""
    rows = trips(spark, folder)
    first = rows.withColumn(fv.FILE_NAME, F.lit("a.parquet"))
    again = first.filter(F.col("VendorID") == 1)
    elsewhere = rows.filter(F.col("RatecodeID") == 3).withColumn(fv.FILE_NAME, F.lit("b.parquet"))
    return harmonize.stack([first, again, elsewhere])


def dedup_exact(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.drop_exact_duplicates(stacked_with_repeats(spark, folder))


def dedup_business_keys(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.drop_business_duplicates(stacked_with_repeats(spark, folder))


def dedup_counts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.duplicate_counts(stacked_with_repeats(spark, folder))


# Silver and gold


def silver_trips(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder)


def silver_as_worded(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder, AS_WORDED)


def silver_with_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Trips as their monthly files have them, and those of vendor 1 landed once more: by the rules as worded
    each counts once, under the file that sorts first."""
    published = trips(spark, folder).withColumn(
        fv.FILE_NAME, F.date_format(landing_drop.published_in(), landing_drop.NAME_PATTERN)
    )
    again = published.filter(F.col("VendorID") == 1).withColumn(fv.FILE_NAME, F.lit("yellow_tripdata_again.parquet"))
    return silver_rows(harmonize.stack([published, again]), AS_WORDED)


def gold(grain: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rollup.gold_by(silver(spark, folder), grain)

    return query


def gold_month_focus(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.gold_focus(silver(spark, folder), fv.FOCUS_MONTH)


def gold_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The three calendar tables stacked, all from the same cells and so from one scan."""
    cells = rollup.trip_cells(silver(spark, folder))
    return harmonize.stack(
        [rollup.gold_by_from_cells(cells, grain).withColumn("grain", F.lit(grain)) for grain in fv.GRAINS]
    )


def gold_daily_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.gold_by(silver(spark, folder), "day", calendar="bucket")


def gold_monthly_places(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each month among the rows as the roll-up gives them, which is that of time."""
    rows = rollup.gold_by(silver(spark, folder), "month").select(fv.TIME_SLICE, "total_trips")
    return rows.withColumn("place", F.monotonically_increasing_id() + 1)


def gold_display(grain: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return gold(grain)(spark, folder).withColumnRenamed(fv.TIME_SLICE, grain.upper())

    return query


def gold_monthly_all_trips(spark: SparkSession, folder: str) -> DataFrame:
    """All metrics over every trip, before any gate."""
    return rollup.gold_by(trips(spark, folder), "month")


def hourly_trip_volume(spark: SparkSession, folder: str) -> DataFrame:
    focus = rollup.gold_focus(silver(spark, folder), fv.FOCUS_MONTH)
    return rollup.hour_profile(focus).select(fv.HOUR_SLICE, "total_trips")


def travel_time_stats(spark: SparkSession, folder: str) -> DataFrame:
    timed = rollup.with_travel_time(trips(spark, folder))
    return rollup.rollup(timed, "hour", fv.PICKUP, [Measure("travel_time_seconds", decimals=None)])


def events_hourly_rollup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return rollup.rollup(events, "hour", "ts", [Measure("value")], count_name="total_events")


def orders_monthly_rollup(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return rollup.rollup(orders, "month", "o_orderdate", [Measure("o_totalprice")], count_name="total_orders")


def orders_monthly_buckets(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return rollup.rollup(
        orders, "month", "o_orderdate", [Measure("o_totalprice")], calendar="bucket", count_name="total_orders"
    )


def lineitem_tax_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Tax on discounts by month: values with six decimals."""
    cents = " * ".join(f"bigint(rint({name} * 100))" for name in ("l_extendedprice", "l_discount", "l_tax"))
    taxed = table(spark, folder, "lineitem").selectExpr("l_shipdate", f"{cents} / 1e6D AS tax")
    return rollup.rollup(taxed, "month", "l_shipdate", [Measure("tax", decimals=6)], count_name="total_lines")


# Comparison with the mean, and reports


def label_month(spark: SparkSession, folder: str) -> DataFrame:
    months = trips(spark, folder).groupBy(F.month(fv.PICKUP).alias("month")).agg(F.count("*").alias("trips"))
    return months.withColumn("label", label_of(F.col("month"), fv.MONTH_LABELS))


def deviation_status(spark: SparkSession, folder: str) -> DataFrame:
    months = orders_monthly_rollup(spark, folder).select(fv.TIME_SLICE, "total_orders", "total_o_totalprice")
    compared = deviation_from_mean(months, "total_o_totalprice", 2, "mean_of_months", "deviation")
    return compared.withColumn("status", sign_status(F.col("deviation"), ("above", "below", "at mean")))


def baseline_all_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return with_baseline(orders, "o_totalprice", "mean_price", "deviation")


def report_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_revenue(rollup.gold_by(silver(spark, folder), "month"))


def report_hourly_density(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hourly_density(rollup.gold_focus(silver(spark, folder), fv.FOCUS_MONTH))


def report_hourly_density_weighted(spark: SparkSession, folder: str) -> DataFrame:
    focus = rollup.gold_focus(silver(spark, folder), fv.FOCUS_MONTH)
    return reports.hourly_density(focus, "trip_weighted")


def sql_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    views = {"strata_gold_monthly": rollup.gold_by(silver(spark, folder), "month")}
    args = {"gold": "strata_gold_monthly"} | reports.REVENUE_ARGS
    return sources.run_sql_file(spark, SQL_FOLDER / "monthly_revenue.sql", views, args)


def sql_hourly_density(spark: SparkSession, folder: str) -> DataFrame:
    views = {"strata_gold_focus": rollup.gold_focus(silver(spark, folder), fv.FOCUS_MONTH)}
    args = {"gold": "strata_gold_focus"} | reports.DENSITY_ARGS
    return sources.run_sql_file(spark, SQL_FOLDER / "hourly_density.sql", views, args)


# Projections


def narrow_projection(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).select(*fv.COLUMNS_OF_INTEREST)


def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = [f"{text} AS {name}" for name, text in three_parts(fv.PICKUP).items()]
    return trips(spark, folder).selectExpr(
        fv.PICKUP, fv.DROPOFF, *parts, f"{travel_seconds()} AS seconds"
    )


def audit_stamp(spark: SparkSession, folder: str) -> DataFrame:
    stamped = sinks.audit_stamp(trips(spark, folder), *_STAMP, "lineitem.parquet")
    return stamped.drop(fv.AUDIT_TIME)


def table_preview(spark: SparkSession, folder: str) -> DataFrame:
    return sources.preview(trips(spark, folder).orderBy(*[name for name, _ in fv.TRIP_FIELDS]), 10)


# Schema audit and harmonisation


def _stored_footers(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_folder(spark, "footers")
    footers = landing.read_footers(spark, folder)
    sinks.write_table(footers, target)
    return sources.read_table(spark, target, footers.schema)


def schema_fields(spark: SparkSession, folder: str) -> DataFrame:
    return landing.field_rows(landing.read_footers(spark, folder))


def schema_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return harmonize.schema_matrix(landing.field_rows(_stored_footers(spark, folder)))


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Drift among the monthly files of the landing folder, before repair."""
    return harmonize.schema_drift(landing.field_rows(landing.read_footers(spark, landing_folder(spark, folder))))


def schema_common_types(spark: SparkSession, folder: str) -> DataFrame:
    """The type that each drifted field of the landing folder widens to."""
    footers = _stored_footers(spark, landing_folder(spark, folder))
    types = harmonize.common_types(footers)
    drifted = harmonize.schema_drift(landing.field_rows(footers)).select("field")
    wide = spark.createDataFrame(list(types.items()), "field string, common_type string")
    return drifted.join(F.broadcast(wide), "field")


def landing_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """A landing folder with damaged files and odd names: each entry, whether it was loaded, and its rows.
    The files are read where their footers are dealt to."""
    key = (spark.sparkContext.applicationId, folder, "damaged")
    if key not in _landing_folders:
        target = scratch_folder(spark, "damaged")
        _landing_folders[key] = landing_drop.write_landing_drop(table(spark, folder, "lineitem"), target, damaged=True)
    files = _landing_folders[key]
    footers = _stored_footers(spark, files)
    frames = landing.read_landing(spark, files, footers, most_listed=0)
    loaded = harmonize.stack([harmonize.harmonize(rows) for rows in frames])
    counts = loaded.groupBy(fv.FILE_NAME).agg(
        F.lit("loaded").alias("state"), F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers")
    )
    left_out = landing.unreadable_files(footers).select(fv.FILE_NAME).distinct()
    none = F.lit(None).cast("bigint")
    return counts.unionByName(
        left_out.select(fv.FILE_NAME, F.lit("unreadable").alias("state"), none.alias("trips"), none.alias("passengers"))
    )


def harmonized_union(spark: SparkSession, folder: str) -> DataFrame:
    return _harmonized(spark, landing_folder(spark, folder))


def _harmonized(spark: SparkSession, files: str) -> DataFrame:
    frames = landing.read_landing(spark, files, _stored_footers(spark, files))
    return harmonize.stack([harmonize.harmonize(rows) for rows in frames])


def cast_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with NaN passenger counts and fractional rate codes, as a drifted file may have them."""
    drifted = trips(spark, folder).withColumns(
        {
            "passenger_count": F.when(F.col("passenger_count") == 6, float("nan")).otherwise(
                F.col("passenger_count").cast("double")
            ),
            "RatecodeID": F.when(F.col("RatecodeID") == 3, 3.5).otherwise(F.col("RatecodeID").cast("double")),
            fv.FILE_NAME: landing_drop.month_file(F.month(fv.PICKUP)),
        }
    )
    return harmonize.cast_losses(drifted)


# Written layers


def _two_files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The trips as two files, of which the first has no airport fee."""
    rows = trips(spark, folder)
    return {
        "vendor_1.parquet": rows.filter(F.col("VendorID") == 1).drop("airport_fee"),
        "vendor_2.parquet": rows.filter(F.col("VendorID") == 2),
    }


def ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two files of different schemas written as one stamped layer and read back."""
    frames = _two_files(spark, folder)
    return sinks.ingest(frames, scratch_folder(spark, "ingest"), *_STAMP).drop(fv.AUDIT_TIME)


def append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A table of the first file, to which the second is appended with its additional column."""
    name = "strata_append_roundtrip"
    first, second = [
        sinks.audit_stamp(rows, *_STAMP, file).drop(fv.AUDIT_TIME)
        for file, rows in _two_files(spark, folder).items()
    ]
    sinks.write_table(first, name, scratch_folder(spark, "append"))
    sinks.append_widening(second, name)
    return spark.table(name)


def cluster_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _clustered(spark, folder)


def cluster_range_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The window's trips from a clustered layer, of which other days are not read."""
    day_after = VIEW_LAST_DAY + dt.timedelta(days=1)
    return sinks.picked_up_between(_clustered(spark, folder), VIEW_FIRST_DAY, day_after)


def _trips_with_position(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem").withColumn("position", sinks.row_position())
    return trip_view(lineitem, keep=["position"])


def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_folder(spark, "clustered")
    rows = sinks.with_pickup_date(_trips_with_position(spark, folder))
    clustered = sinks.cluster_rows(rows, [fv.PICKUP], tie_break="position")
    sinks.write_table(clustered, target)
    return sources.read_table(spark, target, clustered.schema)


def zorder_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Trips clustered on day and hour together; both are stored, so filters on either skip files."""
    target = scratch_folder(spark, "zorder")
    parts = three_parts(fv.PICKUP)
    keys = (fv.DAY_SLICE, fv.HOUR_SLICE)
    rows = _trips_with_position(spark, folder).selectExpr("*", *[f"{parts[name]} AS {name}" for name in keys])
    clustered = sinks.zorder_rows(rows, keys, 5, tie_break="position")
    sinks.write_table(clustered, target)
    return sources.read_table(spark, target, clustered.schema)


def zorder_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Stored trips laid out again by pickup time and amount together, columns of no small range."""
    source, target = scratch_folder(spark, "stored"), scratch_folder(spark, "zordered")
    rows = trips(spark, folder)
    sinks.write_table(rows, source)
    sinks.optimize_table(spark, source, [fv.PICKUP, "total_amount"], target=target)
    return sources.read_table(spark, target, rows.schema)


# The whole run. The landing folder and the layers are written once per application and version of the table.

_landing_folders: dict[tuple[str, str, str], str] = {}
_stores: dict[tuple[str, str, str], str] = {}


def _version(spark: SparkSession, folder: str) -> str:
    """A digest of the name, size and time of the files of ``lineitem``."""
    return landing.listing_fingerprint(spark, f"{folder}/lineitem.parquet")


def landing_folder(spark: SparkSession, folder: str) -> str:
    key = (spark.sparkContext.applicationId, folder, _version(spark, folder))
    if key not in _landing_folders:
        target = scratch_folder(spark, "landing")
        _landing_folders[key] = landing_drop.write_landing_drop(table(spark, folder, "lineitem"), target)
    return _landing_folders[key]


def medallion_layer(name: str) -> Query:
    """A layer of the run over the landing folder. The store knows which stages are done, so the run goes on
    where an earlier query of the application left it."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        files = landing_folder(spark, folder)
        key = (spark.sparkContext.applicationId, folder, files)
        store = _stores.setdefault(key, scratch_folder(spark, "run"))
        layer = run_medallion(spark, files, store, AS_CODED)[name]
        return layer.drop(fv.AUDIT_TIME) if fv.AUDIT_TIME in layer.columns else layer

    return query


def stored_gold_report(spark: SparkSession, folder: str) -> DataFrame:
    """The revenue report by its SQL file over the stored gold layer."""
    args = {"gold": "strata_stored_gold"} | reports.REVENUE_ARGS
    views = {"strata_stored_gold": medallion_layer("gold_monthly")(spark, folder)}
    return sources.run_sql_file(spark, SQL_FOLDER / "monthly_revenue.sql", views, args)


def resumed_from_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly gold layer by the rules as worded, from the bronze layer that an earlier run stored; the landing
    folder is not read."""
    medallion_layer("bronze")(spark, folder)
    key = (spark.sparkContext.applicationId, folder, landing_folder(spark, folder))
    return run_medallion(spark, None, _stores[key], AS_WORDED)["gold_monthly"].drop(fv.AUDIT_TIME)


def queries() -> dict[str, Query]:
    gate_names = [
        "passenger", "fare", "total", "total_covers_fare", "distance", "rate_code", "pickup_zone",
        "dropoff_zone", "chronology", "duration", "pickup_window",
    ]
    return {
        **{f"gate_{name}": one_gate(name) for name in gate_names},
        "quality_ladder": ladder,
        "null_gate_rows": ladder_with_nulls,
        "focus_month_rows": focus_month_rows,
        "late_arrivals": late_arrivals,
        "dedup_exact": dedup_exact,
        "dedup_business_keys": dedup_business_keys,
        "dedup_counts": dedup_counts,
        "silver_trips": silver_trips,
        "silver_as_worded": silver_as_worded,
        "silver_with_lineage": silver_with_lineage,
        "gold_monthly": gold("month"),
        "gold_daily": gold("day"),
        "gold_hourly": gold("hour"),
        "gold_monthly_places": gold_monthly_places,
        "gold_month_focus": gold_month_focus,
        "gold_from_cells": gold_from_cells,
        "gold_daily_buckets": gold_daily_buckets,
        "gold_monthly_display": gold_display("month"),
        "gold_daily_display": gold_display("day"),
        "gold_hourly_display": gold_display("hour"),
        "gold_monthly_all_trips": gold_monthly_all_trips,
        "hourly_trip_volume": hourly_trip_volume,
        "travel_time_stats": travel_time_stats,
        "events_hourly_rollup": events_hourly_rollup,
        "orders_monthly_rollup": orders_monthly_rollup,
        "orders_monthly_buckets": orders_monthly_buckets,
        "lineitem_tax_rollup": lineitem_tax_rollup,
        "label_month": label_month,
        "deviation_status": deviation_status,
        "baseline_all_orders": baseline_all_orders,
        "report_monthly_revenue": report_monthly_revenue,
        "report_hourly_density": report_hourly_density,
        "report_hourly_density_weighted": report_hourly_density_weighted,
        "sql_monthly_revenue": sql_monthly_revenue,
        "sql_hourly_density": sql_hourly_density,
        "narrow_projection": narrow_projection,
        "calendar_parts": calendar_parts,
        "audit_stamp": audit_stamp,
        "table_preview": table_preview,
        "schema_fields": schema_fields,
        "schema_matrix": schema_matrix,
        "schema_drift": schema_drift,
        "harmonized_union": harmonized_union,
        "cast_losses": cast_losses,
        "ingest_roundtrip": ingest_roundtrip,
        "append_roundtrip": append_roundtrip,
        "cluster_roundtrip": cluster_roundtrip,
        "cluster_range_scan": cluster_range_scan,
        "zorder_roundtrip": zorder_roundtrip,
        "zorder_stored": zorder_stored,
        "schema_common_types": schema_common_types,
        "landing_unreadable": landing_unreadable,
        "medallion_bronze": medallion_layer("bronze"),
        "medallion_cast_losses": medallion_layer("cast_losses"),
        "medallion_silver": medallion_layer("silver"),
        "medallion_ladder": medallion_layer("quality_ladder"),
        "medallion_gold_monthly": medallion_layer("gold_monthly"),
        "medallion_gold_daily": medallion_layer("gold_daily"),
        "medallion_gold_hourly": medallion_layer("gold_hourly"),
        "medallion_gold_focus": medallion_layer("gold_focus"),
        "medallion_monthly_revenue": medallion_layer("report_monthly_revenue"),
        "medallion_hourly_density": medallion_layer("report_hourly_density"),
        "stored_gold_report": stored_gold_report,
        "resumed_from_bronze": resumed_from_bronze,
    }
