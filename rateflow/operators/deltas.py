"""Windows over series of which only the tails have changed.

A row's window looks back a fixed number of rows. So where days of a series were
added, corrected or taken away, its results before the first such day stand, and
those from it on are worked out again from that tail and the rows before it that
the windows look back on. Series without a change are not read at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Changed series whose first days are broadcast at most; more are joined.
BROADCAST_SERIES = 200_000


@dataclass(frozen=True)
class Refreshed:
    """``kept`` rows of the old results and ``redone`` ones, which replace all of
    their series from its first changed day on."""

    kept: DataFrame
    redone: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.kept.unionByName(self.redone)


def refreshed(
    old: DataFrame,
    rows: DataFrame,
    changed: DataFrame,
    keys: list[str],
    order: str,
    look_back: int,
    work: Callable[[DataFrame], DataFrame],
) -> Refreshed:
    """``work(rows)``, from ``old``, which is ``work`` of the rows there were.

    ``changed (keys, order)`` has the days that ``rows`` has and the former rows
    had not, or otherwise, or has no more. ``work`` keeps ``keys`` and ``order``,
    and makes of each row one that depends on the ``look_back`` rows of its
    series before it at most. ``order`` is a date, unique in a series.

    Of ``rows`` the scan is bounded by the first changed day of any series less
    some days; only a series whose days are sparser is read further back.
    """
    first = changed.where(F.col(order).isNotNull()).groupBy(*keys).agg(F.min(order).alias("_first"))
    found = first.agg(F.count("*").alias("n"), F.min("_first").alias("day")).first()
    if not found["n"]:
        return Refreshed(old, old.limit(0))
    hint = F.broadcast if found["n"] <= BROADCAST_SERIES else (lambda frame: frame)

    def tailed(frame: DataFrame) -> DataFrame:
        return frame.join(hint(first), keys)

    since = F.date_sub(F.lit(found["day"]), 3 * look_back + 7)
    near = tailed(rows.where(F.col(order) >= since))
    latest = Window.partitionBy(*keys).orderBy(F.desc(order))
    before = (
        near.where(F.col(order) < F.col("_first"))
        .withColumn("_nth", F.row_number().over(latest))
        .where(F.col("_nth") <= look_back)
    )
    # Series with too few days that near: all of what they look back on, from the
    # days before.
    met = before.groupBy(*keys).agg(F.count("*").alias("_met"))
    short = (
        hint(first)
        .join(hint(met), keys, "left")
        .select(*keys, "_first", F.coalesce("_met", F.lit(0)).alias("_met"))
        .where(F.col("_met") < look_back)
    )
    further = (
        rows.where(F.col(order) < since)
        .join(hint(short), keys)
        .withColumn("_nth", F.row_number().over(latest))
        .where(F.col("_nth") <= look_back - F.col("_met"))
    )
    read = (
        near.where(F.col(order) >= F.col("_first"))
        .select(rows.columns)
        .unionByName(before.select(rows.columns))
        .unionByName(further.select(rows.columns))
    )
    redone = tailed(work(read)).where(F.col(order) >= F.col("_first")).select(old.columns)
    kept = (
        old.join(hint(first), keys, "left")
        .where(F.col("_first").isNull() | (F.col(order) < F.col("_first")))
        .select(old.columns)
    )
    return Refreshed(kept, redone)


def changed_days(former: DataFrame, rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """``(keys, order)`` of the days that two sets of readings do not agree on.

    For when nobody tells what has changed: it reads both.
    """
    places = [*keys, order]
    both = former.select(*places, F.col(value).alias("_old"), F.lit(True).alias("_was")).join(
        rows.select(*places, F.col(value).alias("_new"), F.lit(True).alias("_is")), places, "full"
    )
    same = F.col("_was").isNotNull() & F.col("_is").isNotNull() & F.col("_old").eqNullSafe(F.col("_new"))
    return both.where(~same).select(places)
