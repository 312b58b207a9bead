"""The two report queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import fixed_values as fv
from strata.functions.labels import label_of, sign_status
from strata.operators.deviation import deviation_from_mean
from strata.operators.rollup import hour_profile

# Labels and status texts as the named parameters of the SQL files.
REVENUE_ARGS = {f"month_{month}": label for month, label in fv.MONTH_LABELS.items()} | dict(
    zip(("above", "below", "equal"), fv.REVENUE_STATUS)
)
DENSITY_ARGS = dict(zip(("above", "below", "equal"), fv.DENSITY_STATUS))


def monthly_revenue(
    gold_monthly: DataFrame,
    labels: Mapping[int, str] = fv.MONTH_LABELS,
    status: Sequence[str] = fv.REVENUE_STATUS,
) -> DataFrame:
    """Revenue of each month against the mean month, in month order.

    Revenue is rounded before it is averaged; the status follows the rounded deviation.
    """
    month = F.col(fv.TIME_SLICE).cast("int")
    revenue = gold_monthly.select(
        month.alias("month"),
        label_of(month, labels).alias("nome_mes"),
        F.round("total_amount", 2).alias("faturamento_mes"),
    )
    compared = deviation_from_mean(
        revenue, "faturamento_mes", 2, "media_historica_mensal", "desvio_da_media"
    )
    return (
        compared.withColumn("status_performance", sign_status(F.col("desvio_da_media"), status))
        .orderBy("month")
        .drop("month")
    )


def hourly_density(
    gold_focus: DataFrame,
    hour_mean: str = "mean_of_means",
    status: Sequence[str] = fv.DENSITY_STATUS,
) -> DataFrame:
    """Mean passengers by hour of the focus month against the mean hour, in hour order.

    Only the results are rounded: mean and deviation come from the unrounded hour means.
    """
    hours = hour_profile(gold_focus, hour_mean)
    compared = deviation_from_mean(
        hours, "mean_passengers", 4, "media_global_maio_horas", "desvio_da_media"
    )
    return compared.select(
        F.col(fv.HOUR_SLICE).alias("hora_do_dia"),
        F.round("mean_passengers", 4).alias("media_passageiros_hora"),
        "media_global_maio_horas",
        "desvio_da_media",
        sign_status(F.col("desvio_da_media"), status).alias("status_comportamento_cliente"),
    ).orderBy("hora_do_dia")
