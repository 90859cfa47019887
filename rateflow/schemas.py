"""Column contracts of the tables, as Spark types."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

# POSITION orders the rows of a file: part number, byte offset, row.
_TYPES: dict[str, DataType] = {
    "BIGINT": LongType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "DOUBLE": DoubleType(),
    "INT": IntegerType(),
    "POSITION": DecimalType(38, 0),
    "STRING": StringType(),
}


def _table(columns: str) -> StructType:
    """``name TYPE, ...`` without the running session ``fromDDL`` asks for."""
    schema = StructType()
    for column in columns.split(","):
        name, type_name = column.split()
        schema = schema.add(name, _TYPES[type_name])
    return schema


RAW_OBSERVATIONS = _table(
    "series_file STRING, date STRING, value STRING, series_id STRING, position POSITION"
)
PARSED_OBSERVATIONS = _table(
    "series_file STRING, series_id STRING, date DATE, value DOUBLE, position POSITION"
)
OBSERVATIONS = _table(
    "series_file STRING, series_id STRING, date DATE, value DOUBLE"
)
REJECTED_FILES = _table("series_file STRING, reason STRING")

DIM_DATE = _table(
    "date_key BIGINT, full_date DATE, year INT, quarter INT, month INT, week BIGINT,"
    " is_weekend BOOLEAN, is_business_day BOOLEAN"
)
DIM_SERIES = _table(
    "series_key STRING, series_id STRING, series_name STRING, category STRING,"
    " currency STRING, source STRING, geography_key STRING, country STRING,"
    " region STRING, currency_code STRING"
)
DIM_GEOGRAPHY = _table(
    "geography_key STRING, country STRING, region STRING, currency_code STRING"
)
FACT_MARKET_RATES = _table(
    "date_key BIGINT, series_key STRING, geography_key STRING, value DOUBLE,"
    " change_1d DOUBLE, change_1w DOUBLE, change_1m DOUBLE"
)
FACT_DERIVATIVES = _table(
    "date_key BIGINT, dataset STRING, series_id STRING, value DOUBLE"
)
FX_ANALYTICS_MART = _table(
    "fx_rate_id STRING, rate_date DATE, series_id STRING, series_name STRING,"
    " currency STRING, source STRING, spot_rate DOUBLE, change_1d DOUBLE,"
    " change_1w DOUBLE, change_1m DOUBLE, daily_return DOUBLE,"
    " rolling_volatility_30d DOUBLE"
)
YIELD_CURVE_MART = _table(
    "rate_date DATE, yield_1m DOUBLE, yield_2y DOUBLE, yield_10y DOUBLE,"
    " spread_2y_10y DOUBLE, is_inverted BOOLEAN"
)
RATE_DIFFERENTIAL_MART = _table(
    "rate_date DATE, usd_policy_rate DOUBLE, eur_policy_rate DOUBLE,"
    " usd_eur_differential DOUBLE"
)
INVERSION_REPORT = _table(
    "start_date DATE, end_date DATE, duration_days BIGINT, trading_days BIGINT,"
    " min_spread_2y_10y DOUBLE"
)
