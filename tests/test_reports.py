from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.functions.labels import label_of, sign_status
from strata.plans import catalog, reports
from strata.sources.tables import preview, run_sql_file


def monthly(spark, amounts):
    return spark.createDataFrame(list(amounts.items()), "TIME_SLICE int, total_amount double")


def test_revenue_against_the_mean_month(spark):
    rows = reports.monthly_revenue(monthly(spark, {1: 10.0, 2: 20.0, 3: 30.0})).collect()
    assert [row.nome_mes for row in rows] == ["1. Jan", "2. Fev", "3. Mar"]
    assert [row.media_historica_mensal for row in rows] == [20.0] * 3
    assert [row.desvio_da_media for row in rows] == [-10.0, 0.0, 10.0]
    above, below, equal = fv.REVENUE_STATUS
    assert [row.status_performance for row in rows] == [below, equal, above]


def test_revenue_is_rounded_before_it_is_averaged(spark):
    rows = reports.monthly_revenue(monthly(spark, {1: 0.004, 2: 0.008})).collect()
    assert [row.faturamento_mes for row in rows] == [0.0, 0.01]
    # mean 0.005 of the rounded values, not 0.006
    assert [row.desvio_da_media for row in rows] == [-0.01, 0.01]


def test_revenue_columns_and_month_order(spark):
    report = reports.monthly_revenue(monthly(spark, {6: 1.0, 2: 2.0, 10: 3.0}))
    assert report.columns == [
        "nome_mes", "faturamento_mes", "media_historica_mensal", "desvio_da_media", "status_performance",
    ]
    assert [(row.nome_mes, row.faturamento_mes) for row in report.collect()] == [
        ("2. Fev", 2.0), (None, 1.0), (None, 3.0),
    ]


def focus(spark):
    return spark.createDataFrame(
        [(5, 1, 0, 1, 4, 4.0), (5, 2, 0, 3, 3, 1.0), (5, 1, 7, 2, 2, 1.0), (5, 9, 7, 1, 1, 1.00004)],
        "MONTH_SLICE int, DAY_SLICE int, HOUR_SLICE int, total_trips long, total_passenger_count long, "
        "avg_passenger_count double",
    )


def test_density_rounds_only_its_results(spark):
    rows = reports.hourly_density(focus(spark)).collect()
    assert [row.hora_do_dia for row in rows] == [0, 7]
    assert [row.media_passageiros_hora for row in rows] == [2.5, 1.0]
    # hour means 2.5 and 1.00002: the deviation comes from the unrounded mean 1.75001
    assert [row.media_global_maio_horas for row in rows] == [1.75, 1.75]
    assert [row.desvio_da_media for row in rows] == [0.75, -0.75]
    assert reports.hourly_density(focus(spark), "trip_weighted").first().media_passageiros_hora == 1.75


def test_sql_texts_give_the_reports(spark):
    views = {"lake.gold.monthly": monthly(spark, {1: 10.0, 2: 20.005, 3: 31.0, 6: 1.0})}
    by_sql = run_sql_file(spark, catalog.SQL_FOLDER / "monthly_revenue.sql", views, {"gold": "lake_gold_monthly"} | reports.REVENUE_ARGS)
    by_frame = reports.monthly_revenue(next(iter(views.values())))
    assert by_sql.collect() == by_frame.collect() and by_sql.columns == by_frame.columns

    views = {"lake.gold.focus": focus(spark)}
    by_sql = run_sql_file(spark, catalog.SQL_FOLDER / "hourly_density.sql", views, {"gold": "lake_gold_focus"} | reports.DENSITY_ARGS)
    by_frame = reports.hourly_density(focus(spark))
    assert by_sql.collect() == by_frame.collect() and by_sql.columns == by_frame.columns


def test_a_null_deviation_counts_as_the_mean_in_sql_too(spark):
    views = {"nulls": monthly(spark, {1: 10.0, 2: None, 3: 12.0})}
    args = {"gold": "nulls"} | reports.REVENUE_ARGS
    by_sql = run_sql_file(spark, catalog.SQL_FOLDER / "monthly_revenue.sql", views, args).collect()
    assert by_sql == reports.monthly_revenue(views["nulls"]).collect()
    assert by_sql[1].desvio_da_media is None and by_sql[1].status_performance == fv.REVENUE_STATUS[2]


def test_a_sql_text_may_name_its_tables(spark, tmp_path):
    text = tmp_path / "query.sql"
    text.write_text("SELECT sum(total_amount) AS s FROM lake.gold.monthly -- lake.gold.monthly_old\n;\n")
    views = {"lake.gold.monthly": monthly(spark, {1: 1.5, 2: 2.5})}
    assert run_sql_file(spark, text, views).first().s == 4.0


def test_labels_and_status(spark):
    rows = spark.createDataFrame([(1, 2.0), (6, -0.5), (5, 0.0), (None, None)], "m int, d double")
    labelled = rows.select(label_of(F.col("m"), fv.MONTH_LABELS), sign_status(F.col("d"), ("up", "down", "flat")))
    assert [tuple(row) for row in labelled.collect()] == [
        ("1. Jan", "up"), (None, "down"), ("5. Mai", "flat"), (None, "flat"),
    ]


def test_preview_limits(spark):
    assert preview(spark.range(50)).count() == 10
    assert preview(spark.range(50), 3).count() == 3
