"""Landing folders: what the files hold, and their rows.

An entry of the folder is one Parquet file, or one subfolder of Parquet part files; its name is the
lineage of its rows. Footers are read by the executors, a bounded number of tasks whatever the
number of files, and each file is opened once for them. Rows are then read with one scan per distinct
schema, so the plan grows with the number of schemas and not with the number of files.

A file that is no Parquet, or holds a type that Spark has none for, is listed with the reason and left out.
Paths are kept as they are named, blanks and brackets included; ``uri`` is the encoded form.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import fixed_values as fv

_PATTERN = "*.parquet"
_FOOTERS = (
    "uri string, fields array<struct<name: string, type: string, ddl: string>>, "
    "schema_ddl string, row_groups int, error string"
)
# Up to so many paths outside the commonest schema are named in a plan; more are dealt to executors.
MOST_LISTED = 1000
MOST_READERS = 100_000


def read_footers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per landing file: FILE_NAME, path, uri, fields, schema_ddl, row_groups, error.

    ``error`` is set, and the fields are empty, for a file that cannot be read.
    """
    uris = _files(spark, folder).select(F.col("_metadata.file_path").alias("uri"))
    tasks = max(1, 4 * spark.sparkContext.defaultParallelism)
    footers = uris.coalesce(tasks).mapInPandas(_footer_reader(), _FOOTERS)
    path = _decoded(F.col("uri"))
    return footers.select(_entry_name(path, folder).alias(fv.FILE_NAME), path.alias("path"), "*")


def listing_fingerprint(spark: SparkSession, folder: str) -> str:
    """A digest of the names, sizes and times of the landing files, none of which is opened."""
    files = _files(spark, folder).select("path", "length", "modificationTime")
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    count, total = files.agg(F.count("*"), mark).first()
    return f"{count}:{total}"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", _PATTERN).load(folder)


def _decoded(uri: Column) -> Column:
    """The path that an encoded file path stands for; a plus sign stands for itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def field_rows(footers: DataFrame) -> DataFrame:
    """The footers in long form: FILE_NAME, FIELD_NAME, VARIABLE_TYPE, once for part files that agree."""
    fields = footers.select(fv.FILE_NAME, F.explode("fields").alias("field"))
    return fields.select(
        fv.FILE_NAME,
        F.col("field.name").alias(fv.FIELD_NAME),
        F.col("field.type").alias(fv.VARIABLE_TYPE),
    ).distinct()


def unreadable_files(footers: DataFrame) -> DataFrame:
    """The files a load leaves out, with the reason."""
    return footers.filter(F.col("error").isNotNull()).select(fv.FILE_NAME, "path", "error")


def read_landing(
    spark: SparkSession, folder: str, footers: DataFrame, most_listed: int = MOST_LISTED
) -> list[DataFrame]:
    """The rows of the readable files, as one DataFrame per distinct schema, with FILE_NAME.

    Pass stored footers: they are looked at more than once. Files of the commonest schema are read as "the
    folder without the others", whose paths are named in the plan while there are at most ``most_listed``.
    With more, no path comes to the driver: the footers are dealt out and executors read the files.
    """
    readable = footers.filter(F.col("error").isNull())
    schemas = [
        (row.schema_ddl, row.groups)
        for row in readable.groupBy("schema_ddl")
        .agg(F.count("*").alias("files"), F.sum("row_groups").alias("groups"))
        .orderBy(F.desc("files"), "schema_ddl")
        .collect()
    ]
    if not schemas:
        raise ValueError(f"no readable Parquet file in {folder}")
    commonest = schemas[0][0]
    odd = footers.filter(F.col("error").isNotNull() | (F.col("schema_ddl") != commonest))
    listed = odd.select("path", "uri", "schema_ddl").limit(most_listed + 1).collect()
    if len(listed) > most_listed:
        return [_dealt_out(readable, schema, groups) for schema, groups in schemas]

    def scan(schema: str) -> DataFrame:
        reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
        if schema == commonest:
            rows = reader.option("pathGlobFilter", _PATTERN).parquet(folder)
            if listed:
                # A condition on file metadata alone is decided per file, before any file is opened.
                rows = rows.filter(~F.col("_metadata.file_path").isin([file.uri for file in listed]))
        else:
            rows = reader.parquet(*[_literal(file.path) for file in listed if file.schema_ddl == schema])
        return rows.withColumn(fv.FILE_NAME, _entry_name(_decoded(F.col("_metadata.file_path")), folder))

    return [scan(schema) for schema, _ in schemas]


def _literal(path: str) -> str:
    """The path as a pattern that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _dealt_out(readable: DataFrame, schema: str, groups: int) -> DataFrame:
    """The rows of all files of one schema, a row group at a time, read where the footers are dealt to."""
    units = readable.filter(F.col("schema_ddl") == schema).filter("row_groups > 0").select(
        "uri", fv.FILE_NAME, F.explode(F.expr("sequence(0, row_groups - 1)")).alias("row_group")
    )
    fields = StructType.fromDDL(schema).add(fv.FILE_NAME, "string")
    readers = max(1, min(groups or 1, MOST_READERS))
    return units.repartition(readers, "uri", "row_group").mapInArrow(_row_group_reader(fields), fields)


def _entry_name(path: Column, folder: str) -> Column:
    """First path component below the landing folder."""
    base = re.sub(r"^file:/+", "/", folder).rstrip("/") + "/"
    return F.substring_index(F.substring_index(path, base, -1), "/", 1)


def _opener() -> Callable:
    """The function that opens a Parquet file by its URI, to travel with a task."""

    def opened(uri: str):
        from urllib.parse import quote

        from pyarrow import fs
        from pyarrow import parquet as pq

        uri = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", uri))
        filesystem, key = fs.FileSystem.from_uri(quote(uri, safe="%/:@!$&'()*+,;=~?#"))
        return pq.ParquetFile(key, filesystem=filesystem)

    return opened


def _footer_reader() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The function tasks run. Its helpers are inner functions, so all of it travels with the task and
    executors need no copy of this package."""

    opened = _opener()

    def signed(kind):
        """The type Spark reads an unsigned number as: the next wider one."""
        import pyarrow as pa

        wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.decimal128(20, 0)}
        if pa.types.is_struct(kind):
            return pa.struct([field.with_type(signed(field.type)) for field in kind])
        if pa.types.is_map(kind):
            return pa.map_(signed(kind.key_type), signed(kind.item_type))
        if pa.types.is_list(kind) or pa.types.is_large_list(kind):
            return pa.list_(signed(kind.value_type))
        return wider.get(kind, kind)

    def spark_field(field, column) -> tuple[str, str, str]:
        """Name, type and DDL type that Spark gives a Parquet field."""
        from pyspark.sql.pandas.types import from_arrow_type
        from pyspark.sql.types import TimestampType

        if column is not None and column.physical_type == "INT96":
            spark_type = TimestampType()
        else:
            spark_type = from_arrow_type(signed(field.type), prefer_timestamp_ntz=True)
        return field.name, str(spark_type), spark_type.simpleString()

    def has_time(kind) -> bool:
        import pyarrow as pa

        if pa.types.is_nested(kind):
            return any(has_time(kind.field(i).type) for i in range(kind.num_fields))
        return pa.types.is_time(kind)

    def footer(uri: str) -> tuple:
        import pyarrow as pa
        from pyspark.errors import PySparkTypeError

        try:
            file = opened(uri)
        except (pa.ArrowInvalid, OSError) as problem:
            # An input-output failure is not a verdict on the file: let Spark try the task again.
            if isinstance(problem, pa.ArrowInvalid) or "thrift" in str(problem):
                return uri, [], None, None, str(problem)
            raise
        with file:
            columns = {file.schema.column(i).path: file.schema.column(i) for i in range(len(file.schema))}
            fields = []
            for field in file.schema_arrow:
                try:
                    if has_time(field.type):
                        return uri, [], None, None, f"{field.name} is a time of day, which tables cannot store"
                    fields.append(spark_field(field, columns.get(field.name)))
                except PySparkTypeError:
                    return uri, [], None, None, f"{field.name} has type {field.type}, which Spark cannot read"
            groups = file.metadata.num_row_groups
        ddl = ", ".join(f"`{name.replace('`', '``')}` {ddl}" for name, _, ddl in fields)
        return uri, fields, ddl, groups, None

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["uri", "fields", "schema_ddl", "row_groups", "error"]
        for batch in batches:
            found = pd.DataFrame([footer(uri) for uri in batch["uri"]], columns=columns)
            yield found.astype({"row_groups": "Int32"})

    return footers


def _row_group_reader(fields: StructType) -> Callable:
    """The function tasks run for rows of (uri, FILE_NAME, row_group): the rows of each row group."""
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted, rows_at_once = to_arrow_schema(fields), 1 << 16
    lineage, opened = fv.FILE_NAME, _opener()

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for unit in batch.to_pylist():
                with opened(unit["uri"]) as file:
                    for rows in file.iter_batches(rows_at_once, row_groups=[unit["row_group"]]):
                        columns = [
                            rows.column(field.name).cast(field.type, safe=False) for field in wanted if field.name != lineage
                        ]
                        name = pa.repeat(pa.scalar(unit[lineage], pa.string()), rows.num_rows)
                        yield pa.RecordBatch.from_arrays([*columns, name], schema=wanted)

    return read
