"""Staging: one category of the fact table, with series and dates attached.

One SELECT for each model serves frames and the lasting views of a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateflow.catalog import YIELD_MATURITIES

_MATURITY = " ".join(f"WHEN '{series}' THEN '{name}'" for series, name in YIELD_MATURITIES.items())

#: Model to category, name of its id, and what stands before the currency.
STAGING_MODELS = {
    "stg_fx_rates": ("fx_rate", "fx_rate_id", ""),
    "stg_interest_rates": ("interest_rate", "interest_rate_id", ""),
    "stg_yield_curve": (
        "yield",
        "yield_curve_id",
        f"CASE f.series_key {_MATURITY} END AS maturity,",
    ),
}

# Dates are broadcast outright, being bounded by the calendar; the series of one
# category are left to AQE, as their number is not. The series id is read off the
# fact's key, which equals it: a later filter on it then reaches the fact scan and
# its buckets, and a later window finds them partitioned.
_SELECT = """
SELECT /*+ BROADCAST(d) */
    concat(f.series_key, '_', date_format(d.full_date, 'yyyyMMdd')) AS {id_name},
    d.full_date AS rate_date, f.series_key AS series_id, s.series_name, {extra}
    s.currency, s.source, f.value, f.change_1d, f.change_1w, f.change_1m
FROM {fact} f
JOIN (SELECT * FROM {series} WHERE category = '{category}') s ON f.series_key = s.series_key
JOIN {dates} d ON f.date_key = d.date_key
"""


def staging_select(name: str, fact: str, series: str, dates: str) -> str:
    """The model's SELECT over the named fact and dimensions."""
    category, id_name, extra = STAGING_MODELS[name]
    return _SELECT.format(
        category=category, id_name=id_name, extra=extra, fact=fact, series=series, dates=dates
    )


def staged(star: dict[str, DataFrame], name: str) -> DataFrame:
    """The model over the frames of a star."""
    fact = star["fact_market_rates"]
    return fact.sparkSession.sql(
        staging_select(name, "{fact}", "{series}", "{dates}"),
        fact=fact,
        series=star["dim_series"],
        dates=star["dim_date"],
    )


def create_staging_views(spark: SparkSession, database: str) -> None:
    """The models as views of the database, over its star tables."""
    tables = [f"{database}.{name}" for name in ("fact_market_rates", "dim_series", "dim_date")]
    for name in STAGING_MODELS:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {staging_select(name, *tables)}")


def stg_fx_rates(star: dict[str, DataFrame]) -> DataFrame:
    return staged(star, "stg_fx_rates")


def stg_interest_rates(star: dict[str, DataFrame]) -> DataFrame:
    return staged(star, "stg_interest_rates")


def stg_yield_curve(star: dict[str, DataFrame]) -> DataFrame:
    return staged(star, "stg_yield_curve")
