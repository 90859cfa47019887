"""Carrying the last known value forward along dates, year by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.functions.coercion import nan_to_null
from rateflow.operators.years import GROUP, in_year, join_summary, over_years, with_year


def last_known(
    df: DataFrame,
    order: str,
    columns: dict[str, str],
    include_current: bool,
    keys: list[str] | None = None,
) -> DataFrame:
    """Add ``columns[c]``: the latest non-null ``c`` up to (or before) each row."""
    keys = keys or []
    dated = with_year(df, keys, order)
    closing = dated.groupBy(GROUP).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_close_{c}")
            for c in columns
        ]
    )
    earlier = over_years(keys).rowsBetween(Window.unboundedPreceding, -1)
    opening = closing.select(
        GROUP,
        *[F.last(f"_close_{c}", ignorenulls=True).over(earlier).alias(f"_open_{c}") for c in columns],
    )
    until = in_year(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if include_current else -1
    )
    within = dated.withColumns(
        {name: F.last(c, ignorenulls=True).over(until) for c, name in columns.items()}
    )
    return (
        join_summary(within, opening, keys)
        .withColumns({name: F.coalesce(name, f"_open_{c}") for c, name in columns.items()})
        .drop(GROUP, *[f"_open_{c}" for c in columns])
    )


def forward_fill(
    df: DataFrame, order: str, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Each column independently filled from its latest earlier value."""
    filled = last_known(
        df, order, {c: f"_filled_{c}" for c in columns}, include_current=True, keys=keys
    )
    return filled.withColumns({c: F.col(f"_filled_{c}") for c in columns}).drop(
        *[f"_filled_{c}" for c in columns]
    )


def own_date_changes(
    df: DataFrame, order: str, columns: dict[str, str], keys: list[str] | None = None
) -> DataFrame:
    """Add ``columns[c]``: difference to ``c``'s own previous observation.

    NULL where ``c`` itself is NULL, however many rows lie in between, and
    between two equal infinities.
    """
    known = last_known(
        df, order, {c: f"_before_{c}" for c in columns}, include_current=False, keys=keys
    )
    return known.withColumns(
        {name: nan_to_null(F.col(c) - F.col(f"_before_{c}")) for c, name in columns.items()}
    ).drop(*[f"_before_{c}" for c in columns])
