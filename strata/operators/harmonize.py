"""Schema audit, and bringing files of different schemas to one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from strata import fixed_values as fv

# Numbers that fit a whole-number type when the fraction is cut off: above the first, below the second.
_FITS = {"int": ("-2147483649D", "2147483648D"), "bigint": ("-9223372036854777856D", "9223372036854775808D")}
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def field_metadata(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """FILE_NAME, FIELD_NAME, VARIABLE_TYPE of DataFrames already at hand, in long form. For files
    use ``landing.read_footers``, which does not open them one by one on the driver."""
    rows = [
        (name, field.name, str(field.dataType)) for name, frame in frames.items() for field in frame.schema
    ]
    return spark.createDataFrame(
        rows, f"{fv.FILE_NAME} string, {fv.FIELD_NAME} string, {fv.VARIABLE_TYPE} string"
    )


def field_names(fields: DataFrame) -> list[str]:
    """The distinct field names, sorted: as many as the schemas have, however many files there are."""
    return sorted(row[0] for row in fields.select(fv.FIELD_NAME).distinct().collect())


def schema_matrix(fields: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per file, one column per field, the field's type in each cell or NULL.

    Where the part files of one entry disagree, a cell holds all their types, sorted and joined with "|".
    Spellings that differ in case stay separate columns. Pass ``names`` to save the distinct job.
    """
    columns = list(names) if names is not None else field_names(fields)
    types = F.array_join(F.array_sort(F.collect_set(fv.VARIABLE_TYPE)), "|").alias("types")
    return (
        fields.withColumnRenamed(fv.FILE_NAME, fv.MATRIX_FILE)
        .groupBy(fv.MATRIX_FILE, fv.FIELD_NAME)
        .agg(types)
        .groupBy(fv.MATRIX_FILE)
        .pivot(fv.FIELD_NAME, columns)
        .agg(F.min("types"))
    )


def schema_drift(fields: DataFrame) -> DataFrame:
    """Fields that have more than one type or spelling, compared without regard to case.

    Columns: field, types, spellings (each sorted, joined with "|"), files.
    """

    def distinct_values(name: str):
        return F.array_sort(F.collect_set(name))

    found = fields.groupBy(F.lower(fv.FIELD_NAME).alias("field")).agg(
        distinct_values(fv.VARIABLE_TYPE).alias("types"),
        distinct_values(fv.FIELD_NAME).alias("spellings"),
        F.count_distinct(fv.FILE_NAME).alias("files"),
    )
    return found.filter((F.size("types") > 1) | (F.size("spellings") > 1)).select(
        "field",
        F.array_join("types", "|").alias("types"),
        F.array_join("spellings", "|").alias("spellings"),
        "files",
    )


def common_types(footers: DataFrame) -> dict[str, str]:
    """The narrowest type that every type a field has in the files converts to, by field in lower case.

    Whole numbers widen to wider ones, and with fractions to double or decimal, as Spark's own rules for a
    union have it; types without a common one become string. As large as the schemas, however many files.
    """
    fields = footers.select(F.explode("fields").alias("field"))
    found: dict[str, set[str]] = {}
    for name, ddl in fields.select(F.lower("field.name"), "field.ddl").distinct().collect():
        found.setdefault(name, set()).add(ddl)
    return {name: _widest(footers.sparkSession, sorted(types)) for name, types in sorted(found.items())}


def _widest(spark: SparkSession, types: Sequence[str]) -> str:
    if len(types) == 1:
        return types[0]
    try:
        values = ", ".join(f"CAST(NULL AS {ddl})" for ddl in types)
        return spark.sql(f"SELECT coalesce({values}) AS value").schema["value"].dataType.simpleString()
    except AnalysisException:
        return "string"


def harmonize(
    rows: DataFrame,
    types: Mapping[str, str] = fv.REPAIRED_TYPES,
    names: Iterable[str] = tuple(name for name, _ in fv.TRIP_FIELDS),
) -> DataFrame:
    """Canonical spelling for known fields and the repaired type for those that have one.

    Safe to apply to every file: a field already right is unchanged. Fractions are cut off; a value
    that does not fit (NaN, out of range) becomes NULL and is counted by ``cast_losses``.
    """
    canonical = {name.lower(): name for name in names}
    columns = []
    for field in rows.schema:
        target = canonical.get(field.name.lower(), field.name)
        columns.append(f"{_cast(field, types.get(target))} AS `{target}`")
    return rows.selectExpr(*columns)


def _cast(field: StructField, want: str | None) -> str:
    """The field as type ``want``, NULL where it does not fit.

    Numbers are compared with the range first: ``try_cast`` raises and catches an exception for each
    value that does not fit, and a drifted file may have NaN in a large part of its rows.
    """
    name, have = f"`{field.name}`", field.dataType.simpleString()
    if want is None or have == want:
        return name
    if have in _NUMBERS and want in _FITS:
        low, high = _FITS[want]
        return f"CASE WHEN {name} > {low} AND {name} < {high} THEN cast({name} AS {want}) END"
    return f"try_cast({name} AS {want})"


def cast_losses(rows: DataFrame, types: Mapping[str, str] = fv.REPAIRED_TYPES) -> DataFrame:
    """What ``harmonize`` changes, per file and repaired field, for rows before it.

    Columns: FILE_NAME, FIELD_NAME, values_lost (became NULL), fractions_cut.
    """
    present = {field.name.lower(): field for field in rows.schema}
    repaired = {target: present[target.lower()] for target in types if target.lower() in present}
    counts = []
    for target, field in repaired.items():
        cast = _cast(field, types[target])
        counts.append(
            f"struct('{target}' AS {fv.FIELD_NAME},"
            f" count(`{field.name}`) - count({cast}) AS values_lost,"
            f" count_if({cast} != `{field.name}`) AS fractions_cut)"
        )
    if not counts:
        counts_type = f"{fv.FILE_NAME} string, {fv.FIELD_NAME} string, values_lost bigint, fractions_cut bigint"
        return rows.sparkSession.createDataFrame([], counts_type)
    per_file = rows.groupBy(fv.FILE_NAME).agg(F.expr(f"array({', '.join(counts)})").alias("counts"))
    return per_file.selectExpr(fv.FILE_NAME, "inline(counts)")


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; a frame without a column gives NULL."""
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames)
