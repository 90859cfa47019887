"""Keep-last deduplication without relying on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], value: str, position: Column) -> DataFrame:
    """One row per key, with the value found at the greatest position.

    An aggregate rather than a window: copies collapse on the map side, so a
    key (or file) holding a third of the input sends one row per task. With a
    fixed-width ``position`` (number, decimal, date) Spark hash-aggregates;
    a struct also works but makes it sort every input row first.
    """
    return df.groupBy(*keys).agg(F.max_by(F.col(value), position).alias(value))
