"""Writing layers: lineage stamp, replacement, widening append, clustered files.

A failed write raises, and never costs what was stored before: data goes to a new folder first, and a
catalog table is then pointed at it. So a table may also be replaced by rows computed from itself. Folders
of replaced versions are noted in the table and stay until ``clear_replaced``.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import fixed_values as fv
from strata.functions.layout import morton_key
from strata.operators.harmonize import stack
from strata.sources.tables import is_folder, read_table

# Ranges that a column is divided into for clustering on several columns.
RANK_BITS = 6


def audit_stamp(
    rows: DataFrame, system: str, script: str, at: dt.datetime, file_name: str | None = None
) -> DataFrame:
    """Add the lineage columns. ``at`` is passed in, so every task and every retry stamps the same
    time; without ``file_name`` the FILE_NAME the rows already have is kept."""
    stamp = {
        fv.AUDIT_TIME: F.lit(at),
        fv.AUDIT_SYSTEM: F.lit(system),
        fv.AUDIT_SCRIPT: F.lit(script),
        fv.FILE_NAME: F.col(fv.FILE_NAME) if file_name is None else F.lit(file_name),
    }
    return rows.withColumns(stamp)


def write_table(rows: DataFrame, target: str, folder: str | None = None) -> None:
    """Write a layer, replacing its rows and schema where ``target`` is a catalog table.

    A folder is written once: overwriting it in place would delete the files first, which loses them
    if the job fails or reads them. The files of a table go to ``folder``, or to a new folder of the
    warehouse, and then the table is pointed at them. A managed table is refused: its files would go
    with the old version.
    """
    if is_folder(target):
        rows.write.mode("errorifexists").parquet(target)
        return
    spark = rows.sparkSession
    restore_table(spark, target)
    if spark.catalog.tableExists(target) and _detail(spark, target, "Type") == "MANAGED":
        raise ValueError(f"{target} is a managed table; replacing it would delete its files")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = folder or f"{warehouse}/{target}-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(folder)
    point_table(spark, target, folder, rows.schema)


def point_table(spark: SparkSession, table: str, folder: str, schema: StructType) -> None:
    """Make ``table`` the rows of ``folder``, and note the folder it had.

    With an equal schema one statement of the catalog moves the table. With another one the old table is
    put aside under another name until the new one stands; if the work ends in between, the next
    ``restore_table`` or ``write_table`` brings it back.
    """
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)
        return
    replaced = [*replaced_folders(spark, table), _detail(spark, table, "Location")]
    if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]:
        _note(spark, table, replaced)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return
    spark.sql(f"ALTER TABLE {table} RENAME TO {_aside(table)}")
    try:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)
        _note(spark, table, replaced)
    except Exception:
        restore_table(spark, table)
        raise
    spark.sql(f"DROP TABLE {_aside(table)}")


def restore_table(spark: SparkSession, table: str) -> None:
    """Bring back a table whose replacement did not come to its end."""
    if spark.catalog.tableExists(_aside(table)):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {_aside(table)}")
        else:
            spark.sql(f"ALTER TABLE {_aside(table)} RENAME TO {table}")


def replaced_folders(spark: SparkSession, table: str) -> list[str]:
    """Folders of the versions that later ones replaced."""
    noted = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return [folder for folder in noted.get(_REPLACED, "").split("\n") if folder]


def clear_replaced(spark: SparkSession, table: str) -> list[str]:
    """Delete the folders of replaced versions; readers of an old version have to be done. Returns them."""
    current = _detail(spark, table, "Location")
    folders = [folder for folder in replaced_folders(spark, table) if folder != current]
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(folder), True)
    _note(spark, table, [])
    return folders


_REPLACED = "strata.replaced"


def _aside(table: str) -> str:
    return f"{table}__replaced"


def _note(spark: SparkSession, table: str, folders: Sequence[str]) -> None:
    text = "\n".join(dict.fromkeys(folders)).replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_REPLACED}' = '{text}')")


def _detail(spark: SparkSession, table: str, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == name).collect()
    return rows[-1].data_type if rows else ""


def ingest(
    frames: Mapping[str, DataFrame], target: str, system: str, script: str, at: dt.datetime
) -> DataFrame:
    """Write the stamped rows of all named frames as ``target``, and return the stored rows.

    The frames are widened to one schema first and written by one job, so a failure cannot leave
    some of them in the table.
    """
    stamped = [audit_stamp(rows, system, script, at, name) for name, rows in frames.items()]
    written = stack(stamped)
    write_table(written, target)
    return read_table(written.sparkSession, target, written.schema)


def append_widening(rows: DataFrame, table: str, batch: str | None = None) -> bool:
    """Append to a catalog table by column name. Columns only the rows have are added to the table
    (NULL in its old rows); columns only the table has are NULL in the new rows.

    All columns are checked before anything changes: one whose type could lose values in the table's
    raises. With ``batch`` the rows carry it in the column ``AUD_ING_BATCH``, and a batch of which the table has rows
    is not appended again. An append is one job whose files appear when it commits, so a batch is there as a
    whole or not at all. Returns whether rows were appended.
    """
    spark = rows.sparkSession
    stored = spark.table(table).schema
    known = {field.name.lower(): field for field in stored}
    if batch is not None:
        if fv.AUDIT_BATCH.lower() in known and not spark.table(table).filter(F.col(fv.AUDIT_BATCH) == batch).isEmpty():
            return False
        rows = rows.withColumn(fv.AUDIT_BATCH, F.lit(batch))
    new = []
    for field in rows.schema:
        have = known.get(field.name.lower())
        if have is None:
            new.append(field)
        elif not _keeps_values(field.dataType.simpleString(), have.dataType.simpleString()):
            kinds = field.dataType.simpleString(), have.dataType.simpleString()
            raise ValueError(f"{field.name} is {kinds[0]}, and {table} has it as {kinds[1]}")
    if len({field.name.lower() for field in rows.schema}) < len(rows.schema):
        raise ValueError("two columns have the same name")
    if new:
        added = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    given = {name.lower(): name for name in rows.columns}
    columns = []
    for field in spark.table(table).schema:
        name = given.get(field.name.lower())
        value = F.col(f"`{name}`") if name else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    rows.select(*columns).write.mode("append").insertInto(table)
    return True


def _keeps_values(given: str, stored: str) -> bool:
    """Whether every value of one type is the same value in another."""
    whole = ["tinyint", "smallint", "int", "bigint"]
    if given == stored or given == "void":
        return True
    if given in whole and stored in whole:
        return whole.index(given) < whole.index(stored)
    return (given, stored) in {("float", "double"), ("tinyint", "double"), ("smallint", "double"), ("int", "double")}


def row_position() -> Column:
    """A number for the place of a row in its file, for rows straight from a scan. It tells equal rows
    apart, and a repeated task computes it again, which no random number promises."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def cluster_rows(
    rows: DataFrame, by: Sequence[str | Column], files: int | None = None, tie_break: str | None = None
) -> DataFrame:
    """Lay rows out so that each written file covers a narrow range of ``by``.

    Ties are broken, so rows that share one value of ``by`` spread over several files and no value is
    too large for a task: by a hash of the row, or, for a table that may hold many equal rows, by the
    column ``tie_break`` (see ``row_position``), which is not written. Without ``files`` adaptive
    execution sets the number.
    """
    order = [F.col(column) if isinstance(column, str) else column for column in by]
    keys = [*order, F.col(tie_break) if tie_break else F.xxhash64(*rows.columns)]
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    laid_out = ranged.sortWithinPartitions(*order)
    return laid_out.drop(tie_break) if tie_break else laid_out


def zorder_rows(
    rows: DataFrame, by: Sequence[str], bits: int, files: int | None = None, tie_break: str | None = None
) -> DataFrame:
    """Cluster on several small integer expressions at once, so a filter on any of them skips files."""
    return cluster_rows(rows, [morton_key(by, bits)], files, tie_break)


def with_pickup_date(trips: DataFrame) -> DataFrame:
    """Add the pickup day as a date. Spark skips Parquet data by statistics of dates but not of
    timestamps without time zone, so a range of days is asked of this column."""
    return trips.withColumn(fv.PICKUP_DATE, F.to_date(fv.PICKUP))


def picked_up_between(silver: DataFrame, first: dt.date, after: dt.date) -> DataFrame:
    """Stored trips with ``first <= pickup < after``, skipping the files of other days."""
    return silver.filter(f"{fv.PICKUP_DATE} >= DATE '{first}' AND {fv.PICKUP_DATE} < DATE '{after}'")


def ranked_columns(rows: DataFrame, by: Sequence[str], bits: int = RANK_BITS) -> dict[str, Column]:
    """For each column its rank among about ``2 ** bits`` ranges that hold equally many rows, as an integer.

    The boundaries are approximate percentiles, one row of bounded size from one pass over these columns
    alone. Numbers, dates, timestamps and booleans are ranked by value, strings by the six bytes behind the prefix
    that the smallest and the largest have in common; NULLs
    count with the smallest.
    """
    texts = [name for name in by if rows.schema[name].dataType.simpleString() == "string"]
    skipped = {}
    if texts:
        ends = rows.agg(*[f(F.col(name)).alias(f"{f.__name__}_{name}") for name in texts for f in (F.min, F.max)]).first()
        for name in texts:
            pair = [(ends[f"{end}_{name}"] or "").encode() for end in ("min", "max")]
            skipped[name] = len(os.path.commonprefix(pair))
    keys = {name: _sortable(rows, name, skipped.get(name, 0)) for name in by}
    shares = [part / (1 << bits) for part in range(1, 1 << bits)]
    bounds = rows.agg(
        *[F.percentile_approx(key, shares, 100 << bits).alias(name) for name, key in keys.items()]
    ).first()
    return {name: _rank(key, sorted(set(bounds[name] or []))) for name, key in keys.items()}


def _sortable(rows: DataFrame, name: str, skipped: int) -> Column:
    """A number that sorts as the column does, as far as its digits go; of strings without ``skipped`` bytes."""
    kind, column = rows.schema[name].dataType.simpleString(), F.col(name)
    if kind == "string":
        # Six bytes fit a double; bytes of UTF-8 sort as the strings do.
        head = F.rpad(F.hex(F.substring(column.cast("binary"), skipped + 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _rank(key: Column, bounds: Sequence[float]) -> Column:
    """How many bounds are below the key, by a tree of comparisons."""

    def below(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(key > F.lit(bounds[middle]), below(middle + 1, last)).otherwise(below(first, middle))

    return F.when(key.isNull(), F.lit(0)).otherwise(below(0, len(bounds)))


def zorder_ranked(
    rows: DataFrame, by: Sequence[str], files: int | None = None, tie_break: str | None = None, bits: int = RANK_BITS
) -> DataFrame:
    """Cluster on several columns of any type at once, however their values are distributed: each column counts
    by its rank. ``rows`` should be stored, as they are read once for the ranks and again for the layout."""
    ranks = ranked_columns(rows, by, bits)
    names = [f"_rank_{name}" for name in ranks]
    ranked = rows.withColumns(dict(zip(names, ranks.values())))
    return zorder_rows(ranked, names, bits, files, tie_break).drop(*names)


def optimize_table(
    spark: SparkSession, source: str, by: Sequence[str], files: int | None = None, target: str | None = None
) -> None:
    """Rewrite a stored layer clustered by ``by``, a catalog table in place, a folder into another: by ranges
    of one column, or on several columns at once, so that a filter on any of them skips files."""
    rows = read_table(spark, source).withColumn("_position", row_position())
    if len(by) > 1:
        laid_out = zorder_ranked(rows, by, files, "_position")
    else:
        laid_out = cluster_rows(rows, by, files, "_position")
    write_table(laid_out, target or source)
