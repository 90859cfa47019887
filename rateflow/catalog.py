"""Reference data on the known series and datasets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The known market series
# (series_id, name, category, currency, country, region, currency code, source)
SERIES_CATALOG = [
    ("DGS10", "US 10-Year Treasury Yield", "yield", "USD", "United States", "N. America", "USD", "fred"),
    ("DGS2", "US 2-Year Treasury Yield", "yield", "USD", "United States", "N. America", "USD", "fred"),
    ("DGS1MO", "US 1-Month Treasury Yield", "yield", "USD", "United States", "N. America", "USD", "fred"),
    ("DEXUSEU", "USD/EUR Exchange Rate", "fx_rate", "EUR", "Euro Area", "Europe", "EUR", "fred"),
    ("DEXJPUS", "USD/JPY Exchange Rate", "fx_rate", "JPY", "Japan", "Asia", "JPY", "fred"),
    ("DEXBZUS", "USD/BRL Exchange Rate", "fx_rate", "BRL", "Brazil", "S. America", "BRL", "fred"),
    ("FEDFUNDS", "Fed Funds Rate", "interest_rate", "USD", "United States", "N. America", "USD", "fred"),
    ("EURIBOR_3M", "Euribor 3-Month", "interest_rate", "EUR", "Euro Area", "Europe", "EUR", "ecb"),
    ("EURIBOR_6M", "Euribor 6-Month", "interest_rate", "EUR", "Euro Area", "Europe", "EUR", "ecb"),
    ("EURIBOR_12M", "Euribor 12-Month", "interest_rate", "EUR", "Euro Area", "Europe", "EUR", "ecb"),
    ("EURUSD_SPOT", "EUR/USD Spot Rate", "fx_rate", "USD", "United States", "N. America", "USD", "ecb"),
    ("ECB_DEPOSIT_RATE", "ECB Deposit Facility Rate", "interest_rate", "EUR", "Euro Area", "Europe", "EUR", "ecb"),
]

# What an uncatalogued series is taken to be
DEFAULT_CATEGORY = "derivatives"
DEFAULT_SOURCE = "bis"
DEFAULT_COUNTRY = "Global"
DEFAULT_REGION = "Global"

# Periodic statistics datasets, kept out of the market-rate tables
DERIVATIVE_DATASETS = ("BIS_OTC_DERIV", "BIS_FX_TURNOVER")

# Maturity of each yield series
YIELD_MATURITIES = {"DGS1MO": "1M", "DGS2": "2Y", "DGS10": "10Y"}

# The policy rates compared, and the FX series set against them
USD_POLICY_SERIES = "FEDFUNDS"
EUR_POLICY_SERIES = "ECB_DEPOSIT_RATE"
USD_BRL_SERIES = "DEXBZUS"
VOLATILITY_PAIRS = ("DEXUSEU", "DEXBZUS")

# First date taken from a source when no start is given
DEFAULT_START_DATE = "2015-01-01"

_CATALOG_COLUMNS = [
    "series_id", "series_name", "category", "currency",
    "country", "region", "currency_code", "source",
]


def catalog_ids(source: str | None = None) -> list[str]:
    return [row[0] for row in SERIES_CATALOG if source in (None, row[-1])]


def series_catalog(spark: SparkSession) -> DataFrame:
    """The catalog as a 12-row local relation, safe to broadcast anywhere."""
    columns = dict(zip(_CATALOG_COLUMNS, map(list, zip(*SERIES_CATALOG))))
    return spark.createDataFrame(pa.table(columns))
