import dataclasses

import pytest
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.operators import quality
from strata.plans import catalog, landing_drop, medallion, run_store
from strata.plans.medallion import run_medallion
from strata.session import scratch_folder
from strata.sources.landing import read_footers as landing_files
from strata.sources.trip_view import read_given_table


@pytest.fixture(scope="module")
def landing(spark, data):
    target = scratch_folder(spark, "landing")
    return landing_drop.write_landing_drop(read_given_table(spark, data, "lineitem"), target)


@pytest.fixture(scope="module")
def layers(spark, landing):
    return run_medallion(spark, landing, scratch_folder(spark, "store"), catalog.AS_CODED)


def total(rows, column="total_trips"):
    return rows.agg(F.sum(column)).first()[0]


def test_counts_agree_between_layers(layers):
    silver = layers["silver"].count()
    steps = layers["quality_ladder"].orderBy("step").collect()
    assert steps[0].rows_before == layers["bronze"].count()
    assert steps[-1].gate == "duplicates" and steps[-1].rows_remaining == silver
    assert all(one.rows_remaining >= other.rows_remaining for one, other in zip(steps, steps[1:]))
    for name in ("gold_monthly", "gold_daily", "gold_hourly"):
        assert total(layers[name]) == silver
    assert total(layers["gold_focus"]) == layers["silver"].filter(F.month(fv.PICKUP) == 5).count()
    assert abs(layers["report_monthly_revenue"].agg(F.sum("desvio_da_media")).first()[0]) < 0.05


def test_silver_rows_keep_the_file_they_came_from(layers):
    files = {row.FILE_NAME for row in layers["silver"].select("FILE_NAME").distinct().collect()}
    assert files == {landing_drop.file_name(month) for month in range(1, 7)}


def test_late_trips_count_in_the_month_they_began(layers):
    june = layers["silver"].filter(F.col("FILE_NAME") == landing_drop.file_name(6))
    assert {row[0] for row in june.select(F.month(fv.PICKUP)).distinct().collect()} == {5}


def test_stamp_is_one_moment_per_run(layers):
    assert layers["bronze"].select(fv.AUDIT_TIME).distinct().count() == 1
    assert {row.FILE_NAME for row in layers["gold_daily"].select("FILE_NAME").collect()} == {"gold_daily"}


def test_audit_layers_describe_the_files(layers):
    assert layers["schema_matrix"].count() == layers["bronze"].select("FILE_NAME").distinct().count() > 60
    assert layers["schema_drift"].count() == 6
    assert layers["unreadable_files"].count() == 0


def test_losses_and_the_whole_ladder_are_stored(spark, landing):
    run_medallion(spark, landing, target := scratch_folder(spark, "store"), catalog.AS_CODED)
    assert spark.read.parquet(f"{target}/quality_ladder").count() == 12
    losses = spark.read.parquet(f"{target}/cast_losses")
    assert losses.count() == 5 * losses.select("FILE_NAME").distinct().count() > 300 and total(losses, "values_lost") == 0


def test_a_catalog_store_can_be_run_again(spark, landing, layers):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    for _ in range(2):
        again = run_medallion(spark, landing, "lake", catalog.AS_CODED)
    assert {row.tableName for row in spark.sql("SHOW TABLES IN lake").collect()} >= {
        "bronze", "silver", "gold_monthly", "gold_daily", "gold_hourly", "gold_focus", "quality_ladder",
    }
    for name in ("report_monthly_revenue", "report_hourly_density"):
        assert again[name].collect() == layers[name].collect()


def test_silver_file_size_follows_the_ladder(spark, landing):
    options = dataclasses.replace(catalog.AS_CODED, silver_rows_per_file=25)
    stored = run_medallion(spark, landing, scratch_folder(spark, "store"), options)["silver"]
    assert len(stored.inputFiles()) == -(-stored.count() // 25)


def test_worded_rules_keep_more_trips(spark, landing, layers):
    worded = run_medallion(spark, landing, scratch_folder(spark, "store"), catalog.AS_WORDED)
    assert worded["silver"].count() > layers["silver"].count()


def test_are_landed(spark, data):
    trips = catalog.trips(spark, data)
    folder = catalog.landing_folder(spark, data)
    files = {row.FILE_NAME for row in landing_files(spark, folder).select("FILE_NAME").distinct().collect()}
    late = F.col("PULocationID") % 13 == 0
    months = trips.select(F.add_months(fv.PICKUP, F.when(late, 1).otherwise(0)).alias("day")).distinct().collect()
    assert files == {landing_drop.file_name(row.day.month, row.day.year) for row in months} and len(files) > 60
    bronze = catalog.queries()["medallion_bronze"](spark, data)
    assert bronze.count() == trips.count()
    ladder = catalog.queries()["medallion_ladder"](spark, data).orderBy("step").collect()
    assert ladder[0].rows_before == trips.count() and ladder[10].rows_removed > 0


def test_silver_and_gold_come_from_all_months(spark, data):
    run = [catalog.queries()[f"medallion_{name}"](spark, data) for name in ("silver", "gold_monthly", "bronze")]
    assert run[-1].count() == catalog.trips(spark, data).count()


class Killed(Exception):
    pass


def test_a_killed_run_goes_on_behind_bronze(spark, landing, monkeypatch):
    store = scratch_folder(spark, "store")
    with monkeypatch.context() as patch:
        def killed(*_):
            raise Killed

        patch.setattr(medallion, "silver_rows", killed)
        with pytest.raises(Killed):
            run_medallion(spark, landing, store, catalog.AS_CODED)
    # What a killed attempt may leave: files without a record.
    spark.range(3).write.parquet(f"{store}/silver")

    def not_again(*_, **__):
        raise AssertionError("the landing folder was read again")

    monkeypatch.setattr(medallion, "read_landing", not_again)
    monkeypatch.setattr(medallion, "read_footers", not_again)
    layers = run_medallion(spark, landing, store, catalog.AS_CODED)
    fresh = run_medallion(spark, None, store, catalog.AS_CODED)
    assert layers["silver"].count() == fresh["silver"].count() > 100
    assert "landing_fields" in layers and "landing_fields" not in fresh
    assert spark.read.parquet(f"{store}/silver").columns == ["id"]


def test_a_finished_run_writes_nothing_again(spark, landing, monkeypatch):
    store = scratch_folder(spark, "store")
    first = run_medallion(spark, landing, store, catalog.AS_CODED)

    def not_again(*_, **__):
        raise AssertionError("a layer was written again")

    monkeypatch.setattr(run_store, "write_table", not_again)
    again = run_medallion(spark, landing, store, catalog.AS_CODED)
    assert again["gold_monthly"].collect() == first["gold_monthly"].collect()


def test_a_changed_landing_folder_is_landed_again(spark, data, tmp_path):
    lineitem = read_given_table(spark, data, "lineitem")
    folder = landing_drop.write_landing_drop(lineitem, str(tmp_path / "landing"))
    store = scratch_folder(spark, "store")
    before = run_medallion(spark, folder, store, catalog.AS_CODED)["bronze"].count()
    lost = next((tmp_path / "landing" / landing_drop.file_name(7, 1996)).glob("*.parquet"))
    rows = spark.read.parquet(str(lost)).count()
    lost.unlink()
    assert run_medallion(spark, folder, store, catalog.AS_CODED)["bronze"].count() == before - rows


def test_a_table_of_a_later_version_is_not_taken_for_an_earlier_one(spark, landing):
    spark.sql("CREATE DATABASE IF NOT EXISTS pond")
    coded = run_medallion(spark, landing, "pond", catalog.AS_CODED)["silver"].count()
    worded = run_medallion(spark, landing, "pond", catalog.AS_WORDED)["silver"].count()
    assert run_medallion(spark, landing, "pond", catalog.AS_CODED)["silver"].count() == coded < worded


def test_nothing_to_start_from_is_said(spark):
    with pytest.raises(ValueError, match="no bronze"):
        run_medallion(spark, None, scratch_folder(spark, "store"), catalog.AS_CODED)


def test_bronze_is_scanned_once(spark, landing, monkeypatch):
    monkeypatch.setattr(medallion, "quality_ladder", lambda *_: pytest.fail("bronze was scanned for the ladder"))
    layers = run_medallion(spark, landing, scratch_folder(spark, "store"), catalog.AS_CODED)
    gates = quality.trip_gates(catalog.AS_CODED.gates)
    counted = quality.quality_ladder(layers["bronze"], gates).orderBy("step").collect()
    assert layers["quality_ladder"].orderBy("step").collect()[:-1] == counted
