"""Raw texts to clean observations; files with a bad date are set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.functions.coercion import calendar_day, date_parts, missing_to_null, to_day, to_number
from rateflow.operators.dedupe import keep_last

OBSERVATION_KEY = ["series_file", "series_id", "date"]
_BAD, _OUTSIDE, _MALFORMED = 1, 32, 64  # bits 2 to 16 stand for one to four date parts


def typed_observations(raw: DataFrame) -> DataFrame:
    """Texts coerced; a bad value is NULL, and so is a bad date (see below)."""
    return raw.select(
        "series_file",
        missing_to_null(F.col("series_id")).alias("series_id"),
        to_day(F.col("date")).alias("date"),
        to_number(F.col("value")).alias("value"),
        "position",
    )


def rejected_files(raw: DataFrame) -> DataFrame:
    """``(series_file, reason)``: one unparseable date rejects its whole file.

    A missing date does not, but mixing days, months or years does: the first
    date of a file sets the layout of the rest. A line that its reader marked
    ``malformed`` rejects its file too. What a file contains is or-ed into one
    integer, so the aggregate hashes and combines on the map side, and a row per
    file and task is all that is shuffled.
    """
    seen = raw.groupBy("series_file").agg(F.bit_or(flaws(raw)).alias("seen"))
    return with_reason(seen).where(F.col("reason").isNotNull())


def flaws(raw: DataFrame) -> Column:
    """What a row's date and its reader say of its file, as bits."""
    text = missing_to_null(F.col("date"))
    layout = F.call_function("shiftleft", F.lit(1), date_parts(text))
    bits = F.when(
        text.isNotNull(),
        F.when(calendar_day(text).isNull(), _BAD).when(to_day(text).isNull(), _OUTSIDE).otherwise(layout),
    ).otherwise(0)
    if "malformed" in raw.columns:
        bits = bits.bitwiseOR(F.when(F.col("malformed"), _MALFORMED).otherwise(0))
    return bits


def with_reason(seen: DataFrame) -> DataFrame:
    """``(series_file, reason)`` by the bits ``seen`` in each file; NULL if sound."""
    layouts = F.col("seen").bitwiseAND(~(_BAD | _OUTSIDE | _MALFORMED))
    return seen.select(
        "series_file",
        F.when(F.col("seen").bitwiseAND(_MALFORMED) != 0, "malformed_line")
        .when(F.col("seen").bitwiseAND(_BAD) != 0, "bad_date")
        .when(F.col("seen").bitwiseAND(_OUTSIDE) != 0, "date_out_of_range")
        .when(F.bit_count(layouts) > 1, "mixed_date_layouts")
        .alias("reason"),
    )


def parse_observations(raw: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Every dated reading of the sound files, copies included."""
    return _without_rejected(
        typed_observations(raw).where(F.col("value").isNotNull()), raw, rejected
    )


def clean_observations(raw: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Complete rows of the sound files, the last copy of each key kept.

    ``rejected`` is ``rejected_files(raw)`` read back from a written table. At
    scale write it first: its size is then known when the join is planned, and
    ``raw`` is not scanned for it again.
    """
    return _without_rejected(deduplicated(typed_observations(raw)), raw, rejected)


def deduplicated(observations: DataFrame) -> DataFrame:
    """Incomplete rows get no position, so they lose to any complete one, and
    keys without a complete row end up NULL and are dropped.

    Dropping them before would be moved down to the scan, where each text would
    be parsed once for the filter and again for the result.
    """
    complete = F.col("date").isNotNull() & F.col("value").isNotNull()
    position = F.when(complete, F.col("position"))
    kept = keep_last(observations, OBSERVATION_KEY, "value", position)
    return kept.where(F.col("value").isNotNull())


def _without_rejected(rows: DataFrame, raw: DataFrame, rejected: DataFrame | None) -> DataFrame:
    """Take out the rejected files, after deduplication where there is any.

    An outer join with a filter, not an anti join: the optimizer would move that
    below the aggregate and join raw rows by file, a heavily skewed key. Above
    it, Spark broadcasts the few rejected names once it has measured them. Too
    many for that, and AQE splits a file which fills more than its share of
    tasks (given the written table, as it splits plain shuffles only).
    """
    names = rejected_files(raw) if rejected is None else rejected
    marked = names.select("series_file", F.lit(True).alias("rejected"))
    return (
        rows.join(marked, "series_file", "left")
        .where(F.col("rejected").isNull())
        .drop("rejected")
    )
