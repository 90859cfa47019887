"""Date keys, calendar parts, period labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which column headings of a wide table are periods
PERIOD_HEADING = r"^(19|20)\d{2}[-_]?(Q[1-4]|S[1-2]|H[1-2]|\d{2})?$"


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def inclusive_days(start: Column, end: Column) -> Column:
    return (F.datediff(end, start) + 1).cast("bigint")


def years_before(day: Column, years: int) -> Column:
    return F.add_months(day, -12 * years)


def dated_id(series_id: Column, day: Column) -> Column:
    """``<series>_<yyyymmdd>``; NULL when either part is."""
    return F.concat(series_id, F.lit("_"), F.date_format(day, "yyyyMMdd"))


def is_period_label(label: Column) -> Column:
    return F.trim(label).rlike("(?i)" + PERIOD_HEADING)


def period_headings(columns: list[str]) -> list[str]:
    pattern = re.compile(PERIOD_HEADING, re.IGNORECASE)
    return [name for name in columns if pattern.match(name.strip())]


def period_to_date(label: Column) -> Column:
    """First day of a year, quarter, half-year or month label, else NULL.

    ``yyyyMM`` without a separator is deliberately not a date: such columns
    are dropped by the contract being matched.
    """
    text = F.translate(F.upper(F.trim(label)), "_", "-")
    year = F.substring(text, 1, 4).try_cast("int")
    step = F.regexp_extract(text, r"(\d{1,2})$", 1).try_cast("int")
    month = (
        F.when(text.rlike(r"^(19|20)\d{2}-?$"), F.lit(1))
        .when(text.rlike(r"^(19|20)\d{2}-?Q[1-4]$"), step * 3 - 2)
        .when(text.rlike(r"^(19|20)\d{2}-?[SH][12]$"), step * 6 - 5)
        .when(text.rlike(r"^(19|20)\d{2}-(0[1-9]|1[0-2])$"), step)
    )
    return F.when(month.isNotNull(), F.make_date(year, month, F.lit(1)))
