"""Star schema over clean observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow import catalog
from rateflow.functions.calendar import date_key, is_weekend
from rateflow.operators.windows import add_changes
from rateflow.schemas import DIM_DATE, DIM_GEOGRAPHY, DIM_SERIES, FACT_DERIVATIVES, FACT_MARKET_RATES

# Rows looked back for a day's, a week's and a month's change
CHANGE_LAGS = {"change_1d": 1, "change_1w": 5, "change_1m": 21}


def market_observations(observations: DataFrame) -> DataFrame:
    return observations.where(~F.col("series_file").isin(*catalog.DERIVATIVE_DATASETS))


def derivative_observations(observations: DataFrame) -> DataFrame:
    return observations.where(F.col("series_file").isin(*catalog.DERIVATIVE_DATASETS))


def dim_date(observations: DataFrame) -> DataFrame:
    """One row per day seen in any series: a bounded number, see ``MAX_DAYS``."""
    day = F.col("full_date")
    return (
        observations.select(F.col("date").alias("full_date"))
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.weekofyear(day).cast("bigint").alias("week"),
            is_weekend(day).alias("is_weekend"),
            (~is_weekend(day)).alias("is_business_day"),
        )
        .select(DIM_DATE.names)
    )


def dim_series(series_files: DataFrame) -> DataFrame:
    """Metadata of the distinct series files; unknown ones get the defaults."""
    spark = series_files.sparkSession
    known = catalog.series_catalog(spark).withColumn("known", F.lit(True))
    series = series_files.select(F.col("series_file").alias("series_id")).distinct()

    def or_default(column: str, default: str) -> Column:
        return F.when(F.col("known"), F.col(column)).otherwise(default).alias(column)

    country = or_default("country", catalog.DEFAULT_COUNTRY)
    return series.join(F.broadcast(known), "series_id", "left").select(
        F.col("series_id").alias("series_key"),
        "series_id",
        F.coalesce("series_name", "series_id").alias("series_name"),
        or_default("category", catalog.DEFAULT_CATEGORY),
        "currency",
        or_default("source", catalog.DEFAULT_SOURCE),
        country.alias("geography_key"),
        country,
        or_default("region", catalog.DEFAULT_REGION),
        "currency_code",
    ).select(DIM_SERIES.names)


def dim_geography(series: DataFrame) -> DataFrame:
    return series.select(DIM_GEOGRAPHY.names).distinct()


def fact_market_rates(
    market: DataFrame, series: DataFrame, chunk_rows: int | None = None
) -> DataFrame:
    """Series by date, with changes over rows of the same file and series.

    The series join carries no hint: its size follows the data, so AQE measures
    it and broadcasts it or not.
    """
    changes = add_changes(
        market, ["series_file", "series_id"], "date", "value", CHANGE_LAGS, chunk_rows
    )
    lookup = series.select("series_id", "series_key", "geography_key")
    return (
        changes.join(lookup, "series_id", "left")
        .withColumn("date_key", date_key(F.col("date")))
        .select(FACT_MARKET_RATES.names)
    )


def fact_derivatives(derivatives: DataFrame) -> DataFrame:
    """Dataset by series by date; no changes, as the periods are not daily."""
    return derivatives.select(
        date_key(F.col("date")).alias("date_key"),
        F.col("series_file").alias("dataset"),
        "series_id",
        "value",
    ).select(FACT_DERIVATIVES.names)


def star_schema(
    observations: DataFrame, series_files: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The five tables. ``series_files`` adds files which have no clean row."""
    market = market_observations(observations)
    files = market if series_files is None else market_observations(series_files)
    series = dim_series(files)
    return {
        "dim_date": dim_date(observations),
        "dim_series": series,
        "dim_geography": dim_geography(series),
        "fact_market_rates": fact_market_rates(market, series),
        "fact_derivatives": fact_derivatives(derivative_observations(observations)),
    }
