import datetime as dt
import itertools

import pyarrow.parquet as pq
import pytest
from pathlib import Path
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.functions.calendar import three_parts
from strata.functions.layout import morton_key
from strata.session import scratch_folder
from strata.sinks import tables as sinks
from strata.sources.tables import read_table

STAMP = ("system", "script", dt.datetime(2026, 1, 1))


def ranges(folder: str, column: str) -> list[tuple]:
    """Smallest and largest value of a column per data file, from the footers."""
    found = []
    for path in Path(folder).glob("*.parquet"):
        metadata = pq.ParquetFile(path).metadata
        names = metadata.schema.to_arrow_schema().names
        stats = [
            metadata.row_group(g).column(names.index(column)).statistics for g in range(metadata.num_row_groups)
        ]
        if stats:
            found.append((min(s.min for s in stats), max(s.max for s in stats)))
    return found


def test_stamp_is_the_same_for_every_row(spark):
    rows = sinks.audit_stamp(spark.range(5, numPartitions=3), *STAMP, "f.parquet")
    assert rows.columns == ["id", *fv.AUDIT_FIELDS]
    assert {tuple(row)[1:] for row in rows.collect()} == {(STAMP[2], "system", "script", "f.parquet")}


def test_stamp_keeps_the_file_a_row_came_from(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, FILE_NAME string")
    assert {row.FILE_NAME for row in sinks.audit_stamp(rows, *STAMP).collect()} == {"a", "b"}


FRAMES = {"a": ([(1, 1.5)], "k int, x double"), "b": ([(2, "y")], "k int, s string")}


def frames(spark):
    return {name: spark.createDataFrame(rows, ddl) for name, (rows, ddl) in FRAMES.items()}


def test_ingest_widens_and_replaces(spark):
    sinks.ingest({"old": spark.range(9)}, "ingested", *STAMP)
    rows = sinks.ingest(frames(spark), "ingested", *STAMP)
    assert set(rows.columns) == {"k", "x", "s", *fv.AUDIT_FIELDS}
    found = {row.k: (row.x, row.s, row.FILE_NAME) for row in spark.table("ingested").collect()}
    assert found == {1: (1.5, None, "a"), 2: (None, "y", "b")}


def test_a_folder_is_written_once(spark):
    target = scratch_folder(spark, "ingest")
    sinks.ingest(frames(spark), target, *STAMP)
    with pytest.raises(AnalysisException):
        sinks.ingest({"again": read_table(spark, target)}, target, *STAMP)
    assert read_table(spark, target).count() == 2


def test_a_table_may_be_replaced_by_rows_read_from_it(spark):
    sinks.write_table(spark.range(9), "itself")
    sinks.write_table(spark.table("itself").filter("id > 2"), "itself")
    assert spark.table("itself").count() == 6


def test_a_failing_write_raises_and_leaves_the_table(spark):
    sinks.write_table(spark.range(9), "kept")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.ingest({"bad": spark.range(9).selectExpr("1 / (id - 5) AS x")}, "kept", *STAMP)
    assert spark.table("kept").count() == 9


def test_an_absent_layer_is_named(spark):
    with pytest.raises(AnalysisException, match="no_such_layer"):
        read_table(spark, "no_such_layer")
    with pytest.raises(AnalysisException, match="no_such_folder"):
        read_table(spark, scratch_folder(spark, "no_such_folder"))


def test_append_widens_the_table_and_the_rows(spark):
    sinks.write_table(spark.createDataFrame([(1, 1.5)], "k int, x double"), "grown")
    sinks.append_widening(spark.createDataFrame([("new", 2)], "s string, K int"), "grown")
    sinks.append_widening(spark.createDataFrame([(2.5, 3)], "x double, k int"), "grown")
    rows = spark.table("grown")
    assert rows.columns == ["k", "x", "s"]
    assert sorted(map(tuple, rows.collect())) == [(1, 1.5, None), (2, None, "new"), (3, 2.5, None)]


def test_clustered_files_cover_narrow_ranges(spark, view):
    target = scratch_folder(spark, "clustered")
    sinks.write_table(sinks.cluster_rows(view, [fv.PICKUP], files=8), target)
    found = sorted(ranges(target, fv.PICKUP))
    assert len(found) == 8
    assert all(one[1] <= other[0] for one, other in itertools.pairwise(found))
    assert read_table(spark, target).exceptAll(view).count() == 0 == view.exceptAll(read_table(spark, target)).count()


def test_a_hot_value_spreads_over_files(spark):
    rows = spark.range(30_000, numPartitions=6).selectExpr("if(id % 3 = 0, 5L, id) AS k", "id AS v")
    target = scratch_folder(spark, "hot")
    sinks.write_table(sinks.cluster_rows(rows, ["k"], files=12), target)
    sizes = [pq.ParquetFile(path).metadata.num_rows for path in Path(target).glob("*.parquet")]
    assert sum(sizes) == 30_000 and max(sizes) < 30_000 / 6
    assert sum(1 for low, high in ranges(target, "k") if low <= 5 <= high) >= 4


def test_equal_rows_spread_by_their_position(spark):
    source, target = scratch_folder(spark, "equal"), scratch_folder(spark, "spread")
    sinks.write_table(spark.range(12_000, numPartitions=2).selectExpr("1 AS k", "2 AS v"), source)
    sinks.optimize_table(spark, source, ["k"], files=6, target=target)
    sizes = [pq.ParquetFile(path).metadata.num_rows for path in Path(target).glob("*.parquet")]
    assert len(sizes) == 6 and sum(sizes) == 12_000 and max(sizes) < 4_000
    assert read_table(spark, target).columns == ["k", "v"]


def test_morton_key_interleaves_bits(spark):
    rows = spark.range(32).crossJoin(spark.range(24).withColumnRenamed("id", "h")).selectExpr("int(id) AS d", "int(h) AS h")
    for row in rows.withColumn("key", morton_key(["d", "h"], 5)).collect():
        bits = "".join(h + d for d, h in zip(f"{row.d:05b}", f"{row.h:05b}"))
        assert row.key == int(bits, 2)


def test_morton_key_has_to_fit():
    with pytest.raises(ValueError):
        morton_key(["a", "b"], 32)
    with pytest.raises(ValueError):
        morton_key([], 5)


def test_zorder_skips_files_on_both_keys(spark, view):
    parts = three_parts(fv.PICKUP)
    keyed = view.selectExpr("*", f"{parts['DAY_SLICE']} AS d", f"{parts['HOUR_SLICE']} AS h")
    target = scratch_folder(spark, "zorder")
    sinks.write_table(sinks.zorder_rows(keyed, ["d", "h"], 5, files=16), target)
    by_day = sum(1 for low, high in ranges(target, "d") if low <= 15 <= high)
    by_hour = sum(1 for low, high in ranges(target, "h") if low <= 12 <= high)
    assert by_day <= 10 and by_hour <= 10
    assert read_table(spark, target).count() == view.count()


def test_optimize_rewrites_clustered(spark, view):
    source, target = scratch_folder(spark, "source"), scratch_folder(spark, "optimized")
    sinks.write_table(view, source)
    sinks.optimize_table(spark, source, [fv.PICKUP], files=4, target=target)
    assert len(ranges(target, fv.PICKUP)) == 4
    assert read_table(spark, target).count() == view.count()
    sinks.write_table(view, "trips_to_optimize")
    sinks.optimize_table(spark, "trips_to_optimize", [fv.PICKUP], files=5)
    assert len(spark.table("trips_to_optimize").inputFiles()) == 5
    assert spark.table("trips_to_optimize").count() == view.count()


def rows_read(frame) -> int:
    """Rows the scan of a collected frame handed on, after skipping by statistics."""
    frame.collect()
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_a_range_of_days_skips_the_files_of_other_days(spark, view):
    target = scratch_folder(spark, "skipping")
    sinks.write_table(sinks.cluster_rows(sinks.with_pickup_date(view), [fv.PICKUP], files=8), target)
    stored = read_table(spark, target)
    first, after = dt.date(1995, 2, 1), dt.date(1995, 7, 1)
    wanted = sinks.picked_up_between(stored, first, after)
    times = f"{fv.PICKUP} >= DATE '{first}' AND {fv.PICKUP} < DATE '{after}'"
    assert wanted.count() == view.filter(times).count() > 0
    assert rows_read(wanted) <= view.count() / 4
    # the stored columns of a z-ordered layer skip the same way
    target = scratch_folder(spark, "skipping")
    keyed = view.selectExpr("*", *[f"{part} AS {name}" for name, part in three_parts(fv.PICKUP).items()])
    sinks.write_table(sinks.zorder_rows(keyed, [fv.DAY_SLICE, fv.HOUR_SLICE], 5, files=16), target)
    for condition in ("DAY_SLICE = 15", "HOUR_SLICE = 12"):
        assert rows_read(read_table(spark, target).filter(condition)) <= view.count() * 0.7


def test_a_fault_between_write_and_swap_leaves_the_old_rows(spark, monkeypatch):
    sinks.write_table(spark.range(5), "swapped")

    def fault(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "point_table", fault)
        with pytest.raises(OSError):
            sinks.write_table(spark.range(7).selectExpr("id", "id AS more"), "swapped")
    assert spark.table("swapped").count() == 5


@pytest.mark.parametrize("columns", [["id"], ["id", "'x' AS more"]])
def test_a_fault_inside_the_swap_is_made_good(spark, monkeypatch, columns):
    sinks.write_table(spark.range(5), "halfway")
    with monkeypatch.context() as patch:
        def fault(*_, **__):
            raise OSError("lost")

        patch.setattr(type(spark.catalog), "createTable", fault)
        patch.setattr(sinks, "restore_table", fault)
        if len(columns) > 1:
            with pytest.raises(OSError):
                sinks.point_table(spark, "halfway", "/nowhere", spark.range(1).selectExpr(*columns).schema)
            assert not spark.catalog.tableExists("halfway")
    sinks.restore_table(spark, "halfway")
    assert spark.table("halfway").count() == 5
    sinks.write_table(spark.range(3).selectExpr(*columns), "halfway")
    assert spark.table("halfway").count() == 3 and not spark.catalog.tableExists("halfway__replaced")


def test_replaced_versions_stay_until_cleared(spark):
    for n in (3, 4):
        sinks.write_table(spark.range(n), "versions")
    sinks.write_table(spark.range(5).selectExpr("id", "id * 2 AS twice"), "versions")
    folders = sinks.replaced_folders(spark, "versions")
    assert [spark.read.parquet(folder).count() for folder in folders] == [3, 4]
    assert sinks.clear_replaced(spark, "versions") == folders
    assert not any(Path(folder.removeprefix("file:")).exists() for folder in folders)
    assert spark.table("versions").count() == 5 and sinks.replaced_folders(spark, "versions") == []


def test_a_managed_table_is_not_replaced(spark):
    spark.range(4).write.saveAsTable("managed")
    with pytest.raises(ValueError, match="managed"):
        sinks.write_table(spark.range(2), "managed")
    assert spark.table("managed").count() == 4


def test_a_refused_append_changes_nothing(spark):
    sinks.write_table(spark.createDataFrame([(1,)], "a bigint"), "strict")
    with pytest.raises(ValueError, match="a is double"):
        sinks.append_widening(spark.createDataFrame([(2.75, "x")], "a double, b string"), "strict")
    assert spark.table("strict").columns == ["a"] and spark.table("strict").count() == 1


def test_a_repeated_batch_is_appended_once(spark):
    sinks.write_table(spark.createDataFrame([(1,)], "a bigint"), "batches")
    rows = spark.createDataFrame([(2, "x"), (3, "y")], "a bigint, b string")
    assert sinks.append_widening(rows, "batches", "2023-01") is True
    assert sinks.append_widening(rows, "batches", "2023-01") is False
    assert sinks.append_widening(rows, "batches", "2023-02") is True
    found = [tuple(row) for row in spark.table("batches").collect()]
    assert sorted(found, key=str) == [(1, None, None), *[(a, b, f"2023-0{n}") for a, b in ((2, "x"), (3, "y")) for n in (1, 2)]]


def test_stored_layers_are_zordered_on_columns_of_any_type(spark, view):
    source, target = scratch_folder(spark, "source"), scratch_folder(spark, "ranked")
    rows = view.withColumn("zone", F.concat(F.lit("zone-"), F.lpad(F.col("PULocationID").cast("string"), 3, "0")))
    sinks.write_table(rows, source)
    sinks.optimize_table(spark, source, ["total_amount", "zone"], files=16, target=target)
    stored = read_table(spark, target)
    assert stored.columns == rows.columns
    assert stored.exceptAll(rows).count() == 0 == rows.exceptAll(stored).count()
    for column, value in (("total_amount", 30_000.0), ("zone", "zone-100")):
        found = ranges(target, column)
        assert sum(1 for low, high in found if low <= value <= high) <= 9 < len(found)
    assert rows_read(stored.filter("total_amount BETWEEN 30000 AND 30500")) <= view.count() * 0.6
    assert rows_read(stored.filter("zone = 'zone-100'")) <= view.count() * 0.6


def test_ranks_divide_skewed_values_evenly(spark):
    rows = spark.range(4000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE pow(2, id % 40) END AS d", "make_date(2000 + int(id % 30), 1, 1) AS day",
        "timestamp_seconds(id * id) AS t", "id % 2 = 0 AS b", "concat('é', id % 700) AS s", "cast(id AS decimal(10,2)) AS m",
    )
    ranked = rows.withColumns({f"r_{name}": rank for name, rank in sinks.ranked_columns(rows, rows.columns, 4).items()})
    for name in rows.columns:
        kept = sorted(((row[name], row[f"r_{name}"]) for row in ranked.collect() if row[name] is not None))
        assert [rank for _, rank in kept] == sorted(rank for _, rank in kept)
        assert {rank for _, rank in kept} <= set(range(16))
    assert {row.r_d for row in ranked.filter("d IS NULL").collect()} == {0}
    assert max(row["count"] for row in ranked.groupBy("r_t").count().collect()) < 4000 / 8
