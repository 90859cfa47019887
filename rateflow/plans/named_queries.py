"""Business questions by name, as frames over the marts."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.catalog import VOLATILITY_PAIRS
from rateflow.plans.reports import recent_differential

#: Gives a mart by its name.
Marts = Callable[[str], DataFrame]
_VOLATILITY = "rolling_volatility_30d"


def recent_policy_differential(marts: Marts, as_of: Column | None) -> DataFrame:
    return recent_differential(marts("rate_differential_mart"), as_of).orderBy("rate_date")


def pair_volatility(marts: Marts, as_of: Column | None = None) -> DataFrame:
    compared = marts("fx_analytics_mart").where(F.col("series_id").isin(*VOLATILITY_PAIRS))
    return compared.select("series_id", "rate_date", _VOLATILITY).orderBy("series_id", "rate_date")


def pair_volatility_summary(marts: Marts, as_of: Column | None = None) -> DataFrame:
    figures = {"observations": F.count, "avg_volatility_30d": F.avg,
               "min_volatility_30d": F.min, "max_volatility_30d": F.max}
    return (
        marts("fx_analytics_mart")
        .where(F.col("series_id").isin(*VOLATILITY_PAIRS))
        .groupBy("series_id")
        .agg(*(figure(_VOLATILITY).alias(name) for name, figure in figures.items()))
        .orderBy("series_id")
    )


Question = Callable[[Marts, Column | None], DataFrame]
BUSINESS_QUERIES: dict[str, Question] = {}


def register(name: str, question: Question | str) -> None:
    """Add a named question: a function of the marts and the day, or SQL text over
    the marts' names as ``{name}`` and the day as ``{as_of}``.

    A name is taken once, and SQL must hold more than comments: ValueError.
    """
    if not name or not name.strip():
        raise ValueError("a query needs a name")
    if name in BUSINESS_QUERIES:
        raise ValueError(f"duplicate query name {name!r}")
    BUSINESS_QUERIES[name] = _from_sql(name, question) if isinstance(question, str) else question


def _from_sql(name: str, text: str) -> Question:
    if not re.sub(r"--[^\n]*|/\*.*?\*/|[;\s]", "", text, flags=re.S):
        raise ValueError(f"query {name!r} is empty")
    named = set(re.findall(r"\{(\w+)\}", text)) - {"as_of"}
    body = text.replace("{as_of}", "(SELECT day FROM {as_of})")

    def question(marts: Marts, as_of: Column | None) -> DataFrame:
        frames = {mart: marts(mart) for mart in named}
        spark = next(iter(frames.values())).sparkSession if frames else SparkSession.active()
        if body != text:
            day = F.current_date() if as_of is None else as_of
            frames["as_of"] = spark.range(1).select(day.alias("day"))
        return spark.sql(body, **frames)

    return question


register("usd_eur_differential_5y", recent_policy_differential)
register("fx_volatility_eur_usd_vs_usd_brl", pair_volatility)
register("fx_volatility_eur_usd_vs_usd_brl_summary", pair_volatility_summary)


def run_named(
    spark: SparkSession,
    name: str,
    as_of: dt.date | str | None = None,
    marts: Marts | None = None,
) -> DataFrame:
    """The named question as a lazy frame.

    ``as_of`` defaults to today; marts are tables of the current database unless
    ``marts`` gives them.
    """
    if name not in BUSINESS_QUERIES:
        raise KeyError(f"unknown query {name!r}; known: {sorted(BUSINESS_QUERIES)}")
    day = None if as_of is None else F.lit(as_of).cast("date")
    return BUSINESS_QUERIES[name](marts or spark.table, day)


def run_all_named(
    spark: SparkSession, as_of: dt.date | str | None = None, marts: Marts | None = None
) -> dict[str, DataFrame]:
    return {name: run_named(spark, name, as_of, marts) for name in BUSINESS_QUERIES}
