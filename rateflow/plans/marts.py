"""Marts: FX analytics, yield curve, policy-rate differential."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from rateflow.catalog import EUR_POLICY_SERIES, USD_POLICY_SERIES
from rateflow.functions.coercion import nan_to_null
from rateflow.operators.windows import full_window, over_history, simple_return
from rateflow.schemas import FX_ANALYTICS_MART, RATE_DIFFERENTIAL_MART, YIELD_CURVE_MART

# Rows in the trailing volatility window
ROLLING_ROWS = 30


def fx_analytics_mart(staged: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Daily return and trailing volatility per FX series, in one sort."""

    def analytics(rows: DataFrame, window: WindowSpec) -> DataFrame:
        returns = rows.withColumn("daily_return", simple_return("spot_rate", window))
        return returns.withColumn(
            "rolling_volatility_30d",
            full_window("daily_return", F.stddev_samp("daily_return"), window, ROLLING_ROWS),
        )

    return over_history(
        staged.withColumnRenamed("value", "spot_rate"),
        ["series_id"],
        "rate_date",
        ROLLING_ROWS,
        analytics,
        chunk_rows,
    ).select(FX_ANALYTICS_MART.names)


def yield_curve_mart(staged: DataFrame) -> DataFrame:
    """Maturities side by side, a row for every date with any yield series.

    Conditional maxima over a closed list: one shuffle of partial aggregates,
    where ``pivot`` would plan two.
    """

    def at(maturity: str) -> Column:
        return F.max(F.when(F.col("maturity") == maturity, F.col("value")))

    spread = nan_to_null(F.col("yield_10y") - F.col("yield_2y"))
    return (
        staged.groupBy("rate_date")
        .agg(at("1M").alias("yield_1m"), at("2Y").alias("yield_2y"), at("10Y").alias("yield_10y"))
        .withColumns({"spread_2y_10y": spread, "is_inverted": spread < 0})
        .select(YIELD_CURVE_MART.names)
    )


def rate_differential_mart(staged: DataFrame) -> DataFrame:
    """The two policy rates side by side, a row for every date with any rate."""

    def of(series_id: str) -> Column:
        return F.max(F.when(F.col("series_id") == series_id, F.col("value")))

    return (
        staged.groupBy("rate_date")
        .agg(
            of(USD_POLICY_SERIES).alias("usd_policy_rate"),
            of(EUR_POLICY_SERIES).alias("eur_policy_rate"),
        )
        .withColumn(
            "usd_eur_differential", nan_to_null(F.col("usd_policy_rate") - F.col("eur_policy_rate"))
        )
        .select(RATE_DIFFERENTIAL_MART.names)
    )
