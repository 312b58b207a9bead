import datetime as dt
import math
import os
import subprocess
import sys

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators import harmonize
from strata.sources import landing

AT = dt.datetime(2023, 1, 5, 10)


def table(**changes) -> pa.Table:
    columns = {
        "VendorID": pa.array([1, 2], pa.int32()),
        "passenger_count": pa.array([1, 2], pa.int64()),
        "RatecodeID": pa.array([1, 6], pa.int64()),
        "tpep_pickup_datetime": pa.array([AT, AT], pa.timestamp("us")),
        "total_amount": pa.array([1.5, 2.5], pa.float64()),
    } | changes
    return pa.table({name: column for name, column in columns.items() if column is not None})


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    odd = table(
        VendorID=pa.array([1, 2], pa.int64()),
        passenger_count=pa.array([3.0, math.nan], pa.float64()),
        RatecodeID=pa.array([1.0, 2.5], pa.float64()),
        airport_fee=pa.array([1.25, None], pa.float64()),
    )
    capital = table(Airport_fee=pa.array([1.25, 0.0], pa.float64()))
    pq.write_table(odd, root / "trips-01.parquet")
    pq.write_table(table(), root / "trips-02.parquet")
    for month in ("03", "04"):
        pq.write_table(capital, root / f"trips-{month}.parquet")
    (root / "trips-05.parquet").mkdir()
    pq.write_table(capital.slice(0, 1), root / "trips-05.parquet" / "part-0.parquet")
    pq.write_table(capital.slice(1, 1), root / "trips-05.parquet" / "part-1.parquet")
    (root / "trips-06.parquet").write_text("this is no Parquet file")
    (root / "notes.txt").write_text("neither is this")
    return str(root)


@pytest.fixture(scope="module")
def footers(spark, folder):
    return landing.read_footers(spark, folder).cache()


@pytest.fixture(scope="module")
def frames(spark, folder, footers):
    return landing.read_landing(spark, folder, footers)


def test_matrix_has_a_row_per_file_and_a_column_per_spelling(footers):
    matrix = harmonize.schema_matrix(landing.field_rows(footers))
    assert {"Airport_fee", "airport_fee"} <= set(matrix.columns)
    cells = {row.File_Name: row.asDict() for row in matrix.collect()}
    assert sorted(cells) == [f"trips-0{n}.parquet" for n in range(1, 6)]
    assert cells["trips-01.parquet"]["passenger_count"] == "DoubleType()"
    assert cells["trips-02.parquet"]["passenger_count"] == "LongType()"
    assert cells["trips-02.parquet"]["tpep_pickup_datetime"] == "TimestampNTZType()"


def test_types_are_the_ones_spark_reads(spark, folder, footers):
    fields = landing.field_rows(footers)
    for name in ("trips-01.parquet", "trips-05.parquet"):
        found = {row.FIELD_NAME: row.VARIABLE_TYPE for row in fields.filter(F.col("FILE_NAME") == name).collect()}
        read = spark.read.parquet(f"{folder}/{name}").schema
        assert found == {field.name: str(field.dataType) for field in read}


def test_more_types(spark, tmp_path):
    frame = pd.DataFrame({"t": pd.to_datetime(["2023-01-01"])})
    pq.write_table(pa.Table.from_pandas(frame), tmp_path / "int96.parquet", use_deprecated_int96_timestamps=True)
    spark.sql(
        "SELECT date '2023-01-01' AS d, 1.5BD AS m, array(1.0f) AS a, timestamp '2023-01-01' AS t, true AS b, "
        "named_struct('x', 1) AS s, binary('x') AS y"
    ).write.parquet(f"{tmp_path}/spark.parquet")
    fields = landing.field_rows(landing.read_footers(spark, str(tmp_path))).collect()
    for name in ("int96.parquet", "spark.parquet"):
        read = {field.name: field.dataType.simpleString() for field in spark.read.parquet(f"{tmp_path}/{name}").schema}
        assert {row.FIELD_NAME for row in fields if row.FILE_NAME == name} == set(read)
    types = {(row.FILE_NAME, row.FIELD_NAME): row.VARIABLE_TYPE for row in fields}
    assert types["int96.parquet", "t"] == types["spark.parquet", "t"] == "TimestampType()"
    assert types["spark.parquet", "m"] == "DecimalType(2,1)"


def test_unreadable_files_are_reported_and_left_out(footers, frames):
    assert [row.FILE_NAME for row in landing.unreadable_files(footers).collect()] == ["trips-06.parquet"]
    assert sum(rows.count() for rows in frames) == 10


def test_a_folder_without_parquet_is_refused(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("nothing")
    with pytest.raises(ValueError, match="no readable"):
        landing.read_landing(spark, str(tmp_path), landing.read_footers(spark, str(tmp_path)))


def test_one_scan_per_schema_not_per_file(frames):
    # three schemas: drifted numbers, no fee, capital spelling
    assert len(frames) == 3
    assert len(frames[0].inputFiles()) == 8 - 1  # the commonest is read as the folder
    names = {row.FILE_NAME for row in frames[0].select("FILE_NAME").distinct().collect()}
    assert names == {"trips-03.parquet", "trips-04.parquet", "trips-05.parquet"}


def test_drift_ignores_case(footers):
    drift = {row.field: row for row in harmonize.schema_drift(landing.field_rows(footers)).collect()}
    assert set(drift) == {"vendorid", "passenger_count", "ratecodeid", "airport_fee"}
    assert drift["airport_fee"].spellings == "Airport_fee|airport_fee"
    assert drift["airport_fee"].types == "DoubleType()"
    assert drift["passenger_count"].types == "DoubleType()|LongType()"


def test_harmonized_files_stack(frames):
    stacked = harmonize.stack([harmonize.harmonize(rows) for rows in frames])
    types = {field.name: field.dataType.simpleString() for field in stacked.schema}
    assert types["VendorID"] == "int" and types["passenger_count"] == types["RatecodeID"] == "bigint"
    assert [name for name in stacked.columns if name.lower() == "airport_fee"] == ["airport_fee"]
    rows = {}
    for row in stacked.collect():
        rows.setdefault(row.FILE_NAME, []).append(row)
    assert len(rows) == 5
    assert sorted(row.passenger_count or 0 for row in rows["trips-01.parquet"]) == [0, 3]
    assert sorted(row.RatecodeID for row in rows["trips-01.parquet"]) == [1, 2]
    assert [row.airport_fee for row in rows["trips-02.parquet"]] == [None, None]
    assert sorted(row.airport_fee for row in rows["trips-05.parquet"]) == [0.0, 1.25]


def test_harmonizing_twice_changes_nothing(frames):
    for rows in frames:
        once = harmonize.harmonize(rows)
        assert harmonize.harmonize(once).schema == once.schema
        assert sorted(harmonize.harmonize(once).collect()) == sorted(once.collect())


def test_cast_losses_are_counted(frames):
    lost = {}
    for rows in frames:
        for row in harmonize.cast_losses(rows).collect():
            lost[row.FILE_NAME, row.FIELD_NAME] = (row.values_lost, row.fractions_cut)
    assert lost["trips-01.parquet", "passenger_count"] == (1, 0)
    assert lost["trips-01.parquet", "RatecodeID"] == (0, 1)
    assert all(value == (0, 0) for key, value in lost.items() if key[0] != "trips-01.parquet")


def test_metadata_of_frames_at_hand(spark):
    frames = {"a": spark.range(1), "b": spark.range(1).selectExpr("string(id) AS id")}
    fields = harmonize.field_metadata(spark, frames)
    assert sorted(map(tuple, fields.collect())) == [("a", "id", "LongType()"), ("b", "id", "StringType()")]
    assert harmonize.schema_matrix(fields, ["id"]).count() == 2


def test_values_at_the_edges_of_the_types(spark):
    values = [2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0, math.nan, math.inf, -math.inf, None, 1.5]
    rows = spark.createDataFrame([(value,) for value in values], "x double")
    cast = [row.x for row in harmonize.harmonize(rows, {"x": "int"}, ["x"]).collect()]
    assert cast == [2147483647, None, -2147483648, None, None, None, None, None, 1]
    values = [9223372036854774784.0, 9223372036854775808.0, -9223372036854775808.0, -9223372036854777856.0]
    rows = spark.createDataFrame([(value,) for value in values], "x double")
    cast = [row.x for row in harmonize.harmonize(rows, {"x": "bigint"}, ["x"]).collect()]
    assert cast == [9223372036854774784, None, -(2**63), None]
    rows = spark.createDataFrame([(2**31 - 1,), (2**31,), (-(2**31),), (-(2**31) - 1,)], "x bigint")
    cast = [row.x for row in harmonize.harmonize(rows, {"x": "int"}, ["x"]).collect()]
    assert cast == [2**31 - 1, None, -(2**31), None]
    rows = spark.createDataFrame([("7",), ("seven",)], "x string")
    assert [row.x for row in harmonize.harmonize(rows, {"x": "int"}, ["x"]).collect()] == [7, None]


def test_tasks_need_no_copy_of_the_package(tmp_path):
    from pyspark import cloudpickle

    (tmp_path / "task").write_bytes(cloudpickle.dumps(landing._footer_reader()))
    code = "import pickle, sys; pickle.load(open('task', 'rb')); assert 'strata' not in sys.modules"
    environment = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True)


ODD_NAMES = ("blank name.parquet", "[2023] +100%.parquet", "{a,b}*?.parquet", "ünïcode.parquet")


@pytest.mark.parametrize("most_listed", [1000, 0])
def test_files_with_odd_names_load(spark, tmp_path, most_listed):
    for k, name in enumerate(ODD_NAMES):
        kind = [pa.int32(), pa.int64(), pa.float64(), pa.int32()][k]
        pq.write_table(pa.table({"k": pa.array([k, k + 10], kind)}), tmp_path / name)
    footers = landing.read_footers(spark, str(tmp_path)).cache()
    assert {row.FILE_NAME for row in footers.collect()} == set(ODD_NAMES)
    frames = landing.read_landing(spark, str(tmp_path), footers, most_listed)
    found = {(row.FILE_NAME, int(row.k)) for frame in frames for row in frame.collect()}
    assert found == {(name, k + more) for k, name in enumerate(ODD_NAMES) for more in (0, 10)}
    assert len(frames) == 3


def test_many_odd_files_put_no_path_into_the_plan(spark, tmp_path):
    for k in range(60):
        column = pa.array([k], [pa.int32(), pa.int64()][k % 2])
        pq.write_table(pa.table({"k": column}), tmp_path / f"file-{k}.parquet")
    (tmp_path / "bad.parquet").write_text("no")
    footers = landing.read_footers(spark, str(tmp_path)).cache()
    named, dealt = (landing.read_landing(spark, str(tmp_path), footers, most) for most in (40, 5))

    def plans(frames):
        return "".join(frame._jdf.queryExecution().toString() for frame in frames)

    assert len(named[1].inputFiles()) == 30 and "file-" not in plans(dealt)
    for frames in (named, dealt):
        assert sorted(int(row.k) for frame in frames for row in frame.collect()) == list(range(60))


def test_executors_read_the_types_that_spark_reads(spark, tmp_path):
    frame = pd.DataFrame({"t": pd.to_datetime(["2023-01-01 10:00"])})
    pq.write_table(pa.Table.from_pandas(frame), tmp_path / "int96.parquet", use_deprecated_int96_timestamps=True)
    unsigned = {f"u{bits}": pa.array([1, None, 2], getattr(pa, f"uint{bits}")()) for bits in (8, 16, 32, 64)}
    unsigned["nested"] = pa.array([{"x": 1, "y": [1]}, None, {"x": 2, "y": []}], pa.struct([("x", pa.uint16()), ("y", pa.list_(pa.uint8()))]))
    pq.write_table(pa.table(unsigned), tmp_path / "unsigned.parquet", row_group_size=2)
    spark.sql(
        "SELECT date '2023-01-01' AS d, 1.5BD AS m, array(1.0f) AS a, timestamp '2023-01-01' AS t, true AS b, "
        "named_struct('x', 1) AS s, binary('x') AS y, timestamp_ntz '2023-01-01' AS n, map('k', 1) AS mm"
    ).coalesce(1).write.parquet(f"{tmp_path}/spark.parquet")
    footers = landing.read_footers(spark, str(tmp_path)).cache()
    dealt = landing.read_landing(spark, str(tmp_path), footers, most_listed=0)
    for frame in dealt:
        name = frame.first().FILE_NAME
        read = spark.read.parquet(f"{tmp_path}/{name}")
        assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in frame.schema][:-1]
        assert sorted(map(str, read.collect())) == sorted(str(row) for row in frame.drop("FILE_NAME").collect())
    assert len(dealt) == 3


def test_types_spark_has_none_for_are_listed(spark, tmp_path):
    pq.write_table(pa.table({"t": pa.array([1], pa.time64("us")), "k": [1]}), tmp_path / "time.parquet")
    pq.write_table(pa.table({"k": [1]}), tmp_path / "fine.parquet")
    footers = landing.read_footers(spark, str(tmp_path)).cache()
    assert [(row.FILE_NAME, "time of day" in row.error) for row in landing.unreadable_files(footers).collect()] == [("time.parquet", True)]
    assert sum(rows.count() for rows in landing.read_landing(spark, str(tmp_path), footers)) == 1


def test_part_files_that_disagree_show_all_their_types(spark, tmp_path):
    (tmp_path / "month.parquet").mkdir()
    for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64())):
        pq.write_table(pa.table({"k": pa.array([k], kind)}), tmp_path / "month.parquet" / f"part-{k}.parquet")
    fields = landing.field_rows(landing.read_footers(spark, str(tmp_path)))
    assert fields.count() == 2
    assert harmonize.schema_matrix(fields).first().k == "IntegerType()|LongType()"


def test_common_types(spark, tmp_path):
    kinds = [(pa.int32(), pa.string()), (pa.uint32(), pa.int32()), (pa.float64(), pa.string())]
    for k, (one, other) in enumerate(kinds):
        columns = {"a": pa.array([1], one), "B": pa.array(["1"]).cast(other), "c": pa.array([1], pa.int32() if k else pa.uint64())}
        pq.write_table(pa.table(columns), tmp_path / f"{k}.parquet")
    footers = landing.read_footers(spark, str(tmp_path))
    assert harmonize.common_types(footers) == {"a": "double", "b": "bigint", "c": "decimal(20,0)"}


def test_a_listing_shows_changes(spark, tmp_path):
    pq.write_table(pa.table({"k": [1]}), tmp_path / "a.parquet")
    first = landing.listing_fingerprint(spark, str(tmp_path))
    assert landing.listing_fingerprint(spark, str(tmp_path)) == first
    pq.write_table(pa.table({"k": [1, 2]}), tmp_path / "b.parquet")
    assert landing.listing_fingerprint(spark, str(tmp_path)) != first
