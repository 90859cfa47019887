"""Cutting dated rows into series-years, and joining per-year summaries back.

What depends on a whole history is worked out per ``(series, year)``: a window
inside each year, and a summary with one row per year which is small enough to
pass on from year to year. No task ever sees a whole history.

The pair is one struct column. Windows, aggregates and the join back then share
a single hash partitioning, and a missing key matches itself, which plain
equality on the parts would not give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GROUP = "_series_year"


def with_year(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.withColumn(GROUP, F.struct(*keys, F.year(order).alias("_year")))


def in_year(order: str) -> WindowSpec:
    return Window.partitionBy(GROUP).orderBy(order)


def over_years(keys: list[str]) -> WindowSpec:
    """Over the summaries of one series; without keys, of the whole frame."""
    return Window.partitionBy(*[F.col(f"{GROUP}.{key}") for key in keys]).orderBy(f"{GROUP}._year")


def join_summary(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Attach each year's summary. Without keys it has a row per calendar year,
    so it is always broadcast; with keys it grows, so that is left to AQE."""
    return rows.join(summary if keys else F.broadcast(summary), GROUP)
