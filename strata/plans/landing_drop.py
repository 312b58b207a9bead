"""A landing folder of monthly files made from the trip-shaped view, with the schema drift that the
harmonisation has to repair, and one in which some files are damaged. They stand in for downloaded files and hold
every trip of the view."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.sources.trip_view import VIEW_FIRST_DAY, trip_view

NAME_PATTERN = "'yellow_tripdata_'yyyy-MM'.parquet'"
ODD_NAME_PATTERN = "'trips ['yyyy-MM'] +copy.parquet'"


def file_name(month: int, year: int = VIEW_FIRST_DAY.year) -> str:
    return f"yellow_tripdata_{year}-{month:02d}.parquet"


def month_file(month: Column) -> Column:
    """The file name of a month, from 1 to 12."""
    return F.element_at(F.array(*[F.lit(file_name(number)) for number in range(1, 13)]), month)


def as_published(trips: DataFrame, month: int) -> DataFrame:
    """The schema the file of a month has: the first has other number types, the second has no
    airport fee, the rest spell it with a capital."""
    if month == 1:
        return trips.withColumns(
            {name: F.col(name).cast("bigint") for name in ("VendorID", "PULocationID", "DOLocationID")}
            | {name: F.col(name).cast("double") for name in ("passenger_count", "RatecodeID")}
        )
    if month == 2:
        return trips.drop("airport_fee")
    return trips.withColumnRenamed("airport_fee", "Airport_fee")


def published_in() -> Column:
    """First day of the month of the file a trip is in: of its pickup month, or for some trips of the
    month after. December's late trips are in the next year's first file."""
    late = F.when(F.col("PULocationID") % 13 == 0, 1).otherwise(0)
    return F.add_months(F.trunc(fv.PICKUP, "month"), late)


def write_landing_drop(lineitem: DataFrame, folder: str, damaged: bool = False) -> str:
    """Write the entries of all months that the view has trips in, one job per schema variant. Each
    year's January and February files drift as those of ``as_published`` do. A trip without a pickup
    time has no month and is in no file.

    With ``damaged`` the names hold blanks, brackets and plus signs, and the files of every May and October are
    lines of text under the name of a Parquet file.

    A month's rows are brought together first, so the number of part files follows the data; adaptive
    execution splits a large month.
    """
    spark = lineitem.sparkSession
    trips = trip_view(lineitem).withColumn("published", published_in()).filter("published IS NOT NULL")
    pattern = ODD_NAME_PATTERN if damaged else NAME_PATTERN
    named = trips.withColumn(fv.FILE_NAME, F.date_format("published", pattern))
    calendar_month = F.month("published")
    is_text = calendar_month.isin(5, 10) if damaged else F.lit(False)
    variants = {1: calendar_month == 1, 2: calendar_month == 2, 3: (calendar_month > 2) & ~is_text}
    for month, chosen in variants.items():
        rows = as_published(named.filter(chosen).drop("published"), month).hint("rebalance", fv.FILE_NAME)
        staged = f"{folder}-staged/{month}"
        rows.write.partitionBy(fv.FILE_NAME).parquet(staged)
        _publish(spark, staged, folder)
    if damaged:
        lines = named.filter(is_text).select(fv.FILE_NAME, F.to_csv(F.struct(fv.PICKUP, "total_amount")))
        lines.write.partitionBy(fv.FILE_NAME).text(f"{folder}-staged/text")
        _publish(spark, f"{folder}-staged/text", folder, ".txt")
    return folder


def _publish(spark: SparkSession, staged: str, folder: str, ending: str = "") -> None:
    """Move the entries to the landing folder under their own names, without the key Spark puts before. Part
    files with ``ending`` get that of Parquet files."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for entry in files.listStatus(path(staged)):
        key, _, name = unquote(entry.getPath().getName()).partition("=")
        if key != fv.FILE_NAME:
            continue
        if not files.rename(entry.getPath(), path(folder, name)):
            raise OSError(f"{name} cannot be moved to {folder}")
        for part in files.listStatus(path(folder, name)) if ending else []:
            plain = part.getPath().getName()
            if plain.endswith(ending):
                files.rename(part.getPath(), path(path(folder, name), plain.removesuffix(ending) + ".parquet"))
