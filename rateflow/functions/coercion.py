"""Text to typed values: missing markers, numbers, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts which a CSV scan takes as missing (pandas' defaults)
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# The first and last day that a 64-bit nanosecond timestamp holds
# in full. A file with a date outside them is rejected, so one series has at most
# 213,503 days: every per-series window and the date dimension rest on that bound.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"
MAX_DAYS = 213_503

_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"
_ISO_DATE = r"^\s*(\d{4}(?:-\d{1,2}(?:-\d{1,2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?Z?)?)?)?)\s*$"


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(MISSING_TOKENS), text)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def to_number(text: Column) -> Column:
    """Text to DOUBLE; whatever is not a number, missing markers too, is NULL.

    The pattern comes first because a plain cast also takes ``1.5d`` and
    ``NaN``.
    """
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def calendar_day(text: Column) -> Column:
    """ISO date text to DATE (months and years start on day one), else NULL.

    Spaces around and a time of day are left out. The day may be one that no
    series can hold, see ``to_day``.
    """
    day = F.regexp_replace(F.trim(text), "[ T].*$", "")
    return F.when(text.rlike(_ISO_DATE), day.try_cast("date"))


def to_day(text: Column) -> Column:
    """``calendar_day`` from ``FIRST_DAY`` to ``LAST_DAY``, else NULL."""
    day = calendar_day(text)
    return F.when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), day)


def date_parts(text: Column) -> Column:
    """How many parts a date text has: 1 for a year, 2 for a month, 3 for a day,
    4 for a day and a time."""
    timed = text.rlike(r"\S[ T]\d").cast("int")
    return F.size(F.split(text, "-")) + timed
