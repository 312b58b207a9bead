from strata import fixed_values as fv
from strata.operators import dedup

DDL = "k int, x double, FILE_NAME string, AUD_ING_SYSTEM string"
ROWS = [
    (1, 1.5, "a", "s"),
    (1, 1.5, "a", "s"),
    (1, 1.5, "b", "s"),
    (2, None, "b", "s"),
    (2, None, "a", "s"),
    (3, 0.0, "a", "s"),
]


def test_exact_duplicates_go_only_inside_a_file(spark):
    rows = dedup.drop_exact_duplicates(spark.createDataFrame(ROWS, DDL))
    assert rows.count() == 5


def test_business_duplicates_go_across_files_and_keep_the_first_lineage(spark):
    rows = dedup.drop_business_duplicates(spark.createDataFrame(ROWS, DDL).repartition(3))
    assert rows.columns == ["k", "x", "FILE_NAME", "AUD_ING_SYSTEM"]
    assert sorted(map(tuple, rows.collect()), key=str) == [
        (1, 1.5, "a", "s"), (2, None, "a", "s"), (3, 0.0, "a", "s"),
    ]


def test_without_lineage_both_removals_agree(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert dedup.drop_business_duplicates(rows).count() == dedup.drop_exact_duplicates(rows).count() == 2


def test_counts(spark):
    rows = spark.createDataFrame(ROWS, DDL)
    assert tuple(dedup.duplicate_counts(rows).first()) == (6, 1, 5)
    assert tuple(dedup.duplicate_counts(rows, fv.AUDIT_FIELDS).first()) == (6, 3, 3)
    assert tuple(dedup.duplicate_counts(rows.limit(0)).first()) == (0, 0, 0)


def test_a_hot_row_leaves_each_task_once(spark):
    copies = spark.range(60_000, numPartitions=6).selectExpr("int(if(id % 3 = 0, 7, id)) AS k")
    kept = dedup.drop_exact_duplicates(copies)
    rows = kept.collect()
    assert len(rows) == len({row.k for row in rows}) == copies.distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate below the shuffle, a final one above it
    assert plan.count("HashAggregate") >= 2 and plan.count("Exchange") >= 1


def test_business_duplicates_need_no_sort(spark, tmp_path):
    rows = spark.createDataFrame([(k % 50, f"file-{k % 7}", f"s{k % 3}") for k in range(2000)], "k int, FILE_NAME string, AUD_ING_SYSTEM string")
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    kept = dedup.drop_business_duplicates(stored)
    assert "Sort" not in kept._jdf.queryExecution().executedPlan().toString()
    listed, sorted_out = (sorted(map(tuple, dedup.drop_business_duplicates(stored, most_listed=most).collect())) for most in (100, 3))
    assert listed == sorted_out and len(listed) == 50


def test_a_null_lineage_comes_first(spark):
    rows = spark.createDataFrame([(1, "b", "s"), (1, None, "s"), (2, "a", None), (2, "a", "s")], "k int, FILE_NAME string, AUD_ING_SYSTEM string")
    for most in (100, 1):
        found = dedup.drop_business_duplicates(rows, most_listed=most).collect()
        assert sorted(map(tuple, found)) == [(1, None, "s"), (2, "a", None)]
