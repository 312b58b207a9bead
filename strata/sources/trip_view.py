"""A trip-shaped view over ``lineitem``, so that trip results can be checked on the given tables.

Hours, zones and anomalies are derived from the keys; every gate has rows to remove. The view is a
projection: no shuffle, and only the ``lineitem`` columns a query needs are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The pickup window that plays the part of January to May on these tables.
VIEW_FIRST_DAY = dt.date(1997, 1, 1)
VIEW_LAST_DAY = dt.date(1997, 5, 31)


def read_given_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trip_view(lineitem: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 14 trip columns computed from ``lineitem``, and the columns to ``keep``.

    Prices and discounts have two decimals and keys are not negative. Money is computed in whole
    cents (``cents``, ``fare``) and hundredths of cents (``tip``) and divided once at the end, which
    gives the double nearest to the decimal result. Values that several columns use are columns of an
    earlier projection, so each is computed once.
    """
    return (
        lineitem.selectExpr("*", "bigint(rint(l_extendedprice * 100)) AS cents")
        .selectExpr(
            "*",
            "CASE WHEN l_partkey % 97 = 0 THEN -cents ELSE cents END AS fare",
            "cents * bigint(rint(l_discount * 100)) AS tip",
            "CASE WHEN l_linenumber = 2 THEN 0"
            " ELSE int((l_orderkey * 37 + l_linenumber * 101) % 1440) END AS start",
            "CASE WHEN l_partkey % 211 = 0 THEN 1500"
            " ELSE int((l_partkey * 13 + l_linenumber) % 240 - 5) END AS minutes",
        )
        .selectExpr(
            "int(l_suppkey % 2 + 1) AS VendorID",
            "l_shipdate + start * INTERVAL '1' MINUTE AS tpep_pickup_datetime",
            "l_shipdate + (start + minutes) * INTERVAL '1' MINUTE AS tpep_dropoff_datetime",
            "bigint(l_quantity) % 7 AS passenger_count",
            "CASE WHEN l_linenumber = 7 THEN 0D ELSE l_quantity * 0.25D END AS trip_distance",
            "l_partkey % 7 + 1 AS RatecodeID",
            "int(l_partkey % 265 + 1) AS PULocationID",
            "int(l_orderkey % 265 + 1) AS DOLocationID",
            "fare / 100D AS fare_amount",
            "tip / 10000D AS tip_amount",
            "CASE WHEN l_suppkey = 17 THEN -1D WHEN l_suppkey % 31 = 0 THEN (fare - 1000) / 100D"
            " ELSE (fare * 100 + tip) / 10000D END AS total_amount",
            "CASE WHEN l_linestatus = 'O' THEN 2.5D ELSE 0D END AS congestion_surcharge",
            "1D AS improvement_surcharge",
            "CASE l_returnflag WHEN 'R' THEN 1.25D WHEN 'A' THEN 0D END AS airport_fee",
            *keep,
        )
    )


def shipped_for_pickups(lineitem: DataFrame, first: dt.date, after: dt.date) -> DataFrame:
    """The rows whose trips have ``first <= pickup < after``.

    A pickup lies on its ship day, so the range of days holds for ``l_shipdate`` too. That is a
    stored column: rows outside the range are dropped before anything is computed for them.
    """
    return lineitem.filter(f"l_shipdate >= DATE '{first}' AND l_shipdate < DATE '{after}'")


def trips_picked_up(lineitem: DataFrame, first: dt.date, after: dt.date) -> DataFrame:
    """The trips with ``first <= pickup < after``."""
    return trip_view(shipped_for_pickups(lineitem, first, after))
