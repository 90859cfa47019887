"""Contiguous runs of flagged rows, by row position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.operators.years import GROUP, in_year, join_summary, over_years, with_year


def flagged_runs(
    df: DataFrame,
    order: str,
    flag: Column,
    measures: dict[str, Column],
    keys: list[str] | None = None,
) -> DataFrame:
    """One row per run: ``keys``, ``start``, ``end``, ``rows`` and minima.

    ``measures`` maps an output name to the column whose minimum over the run
    is wanted. A NULL flag ends a run; a gap in the calendar does not.

    Runs are found per calendar year and those meeting at a year's end are
    joined up; the last pass only handles runs.
    """
    keys = keys or []
    flagged = with_year(df, keys, order).select(
        GROUP,
        F.col(order).alias("_at"),
        F.coalesce(flag, F.lit(False)).alias("_flag"),
        *[column.alias(name) for name, column in measures.items()],
    )
    so_far = in_year("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = flagged.withColumn("_row", F.row_number().over(in_year("_at"))).withColumn(
        "_gap", F.col("_row") - F.sum(F.col("_flag").cast("int")).over(so_far)
    )
    pieces = (
        rows.where("_flag")
        .groupBy(GROUP, "_gap")
        .agg(
            F.min("_at").alias("start"),
            F.max("_at").alias("end"),
            F.count(F.lit(1)).alias("rows"),
            F.min("_row").alias("_first_row"),
            *[F.min(name).alias(name) for name in measures],
        )
    )

    # Whether the row just before each year's first one was flagged.
    year_ends = flagged.groupBy(GROUP).agg(F.max_by("_flag", "_at").alias("_ends_flagged"))
    year_starts = year_ends.select(
        GROUP, F.lag("_ends_flagged", 1, False).over(over_years(keys)).alias("_carried")
    )

    begins = ~((F.col("_first_row") == 1) & F.col("_carried"))
    by_start = Window.partitionBy(*keys).orderBy("start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        join_summary(pieces, year_starts, keys)
        .withColumns({key: F.col(f"{GROUP}.{key}") for key in keys})
        .withColumn("_run", F.sum(begins.cast("int")).over(by_start))
        .groupBy(*keys, "_run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("rows").alias("rows"),
            *[F.min(name).alias(name) for name in measures],
        )
        .drop("_run")
    )
