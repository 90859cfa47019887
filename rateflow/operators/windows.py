"""Row-based history operators: lags, returns, trailing windows.

A cleaned series has at most one row per day, so it is bounded by the days a
date can take (``MAX_DAYS``) however large the table is, and
``Window.partitionBy(series)`` is balanced: one shuffle, none on a table
bucketed by series. For the opposite shape -- few long series, so few busy
tasks -- pass ``chunk_rows``: every series is then cut into chunks which overlap
by as many rows as the frame looks back. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.functions.coercion import nan_to_null
from rateflow.functions.statistics import ratio
from rateflow.operators.years import GROUP, in_year, join_summary, over_years, with_year

AddColumns = Callable[[DataFrame, WindowSpec], DataFrame]


def over_history(
    df: DataFrame,
    keys: list[str],
    order: str,
    look_back: int,
    add_columns: AddColumns,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Apply ``add_columns(df, window)`` to each series in date order.

    ``look_back`` is how many earlier rows one output row depends on.
    """
    if chunk_rows is None:
        return add_columns(df, Window.partitionBy(*keys).orderBy(order))
    if chunk_rows < look_back:
        raise ValueError(f"chunk_rows must be at least {look_back}, got {chunk_rows}")

    numbered = number_rows(df, keys, order, "_row")
    chunk = F.floor(F.col("_row") / chunk_rows)
    near_end = F.col("_row") % chunk_rows >= chunk_rows - look_back
    copies = (
        numbered.withColumn("_own", chunk)
        .withColumn(
            "_chunk",
            F.explode(
                F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(
                    F.array("_own")
                )
            ),
        )
    )
    window = Window.partitionBy(*keys, "_chunk").orderBy(order)
    return (
        add_columns(copies, window)
        .where(F.col("_chunk") == F.col("_own"))
        .drop("_row", "_own", "_chunk")
    )


def number_rows(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Zero-based position of each row in its series, with no whole-series task.

    Rows are numbered within ``(series, year)``; the few counts per year are
    summed up per series and added on.
    """
    dated = with_year(df, keys, order)
    counts = dated.groupBy(GROUP).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = over_years(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        GROUP, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    numbered = dated.withColumn(name, F.row_number().over(in_year(order)))
    return (
        join_summary(numbered, offsets, keys)
        .withColumn(name, F.col(name) - 1 + F.col("_offset"))
        .drop("_offset", GROUP)
    )


def add_changes(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    lags: dict[str, int],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Difference to the value so many rows (not days) before, one per lag.

    NULL between two infinite values of one sign.
    """

    def changes(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumns(
            {name: nan_to_null(F.col(value) - F.lag(value, n).over(window)) for name, n in lags.items()}
        )

    return over_history(df, keys, order, max(lags.values()), changes, chunk_rows)


def simple_return(value: str, window: WindowSpec) -> Column:
    """``value / previous - 1``; NULL on the first row or after a zero."""
    return ratio(F.col(value), F.lag(value).over(window)) - 1


def full_window(column: str, aggregate: Column, window: WindowSpec, size: int) -> Column:
    """Trailing aggregate, NULL until the frame holds ``size`` non-null values.

    An aggregate over infinite values that is not a number is NULL.
    """
    frame = window.rowsBetween(1 - size, Window.currentRow)
    return F.when(F.count(column).over(frame) >= size, nan_to_null(aggregate.over(frame)))
