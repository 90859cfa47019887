"""Reports on the marts. Nothing here is collected; callers act on the result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from rateflow.catalog import USD_BRL_SERIES, VOLATILITY_PAIRS
from rateflow.functions.calendar import inclusive_days, years_before
from rateflow.functions.statistics import ratio
from rateflow.operators.carry import forward_fill, own_date_changes
from rateflow.operators.correlation import correlate_pairs
from rateflow.operators.islands import flagged_runs
from rateflow.operators.windows import full_window, over_history
from rateflow.plans.marts import ROLLING_ROWS
from rateflow.schemas import INVERSION_REPORT

# Outlier threshold, and the sample size below which to warn
Z_SCORE_THRESHOLD = 3.0
MIN_CHANGE_OBSERVATIONS = 5

_RATES = ["usd_policy_rate", "usd_eur_differential"]
_REPORT_YEARS = 5


# Yield curve

def inversion_report(yield_curve: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per inversion; ``keys`` where the frame holds several curves."""
    runs = flagged_runs(
        yield_curve,
        "rate_date",
        F.col("is_inverted"),
        {"min_spread_2y_10y": F.col("spread_2y_10y")},
        keys,
    )
    return runs.select(
        *(keys or []),
        F.col("start").alias("start_date"),
        F.col("end").alias("end_date"),
        inclusive_days(F.col("start"), F.col("end")).alias("duration_days"),
        F.col("rows").alias("trading_days"),
        "min_spread_2y_10y",
    ).select(*(keys or []), *INVERSION_REPORT.names)


def longest_inversion(inversions: DataFrame) -> DataFrame:
    """The run with most trading days, the earliest of equals; one row."""
    rank = F.struct("trading_days", -F.unix_date("start_date"))
    return inversions.agg(F.max_by(F.struct(*INVERSION_REPORT.names), rank).alias("run")).select(
        "run.*"
    )


# FX volatility

def rolling_zscore(fx: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Add the trailing mean return and each return's z-score.

    The z-score is NULL where volatility is missing or zero.
    """

    def score(rows: DataFrame, window: WindowSpec) -> DataFrame:
        mean = full_window("daily_return", F.avg("daily_return"), window, ROLLING_ROWS)
        return rows.withColumn("rolling_mean_return_30d", mean).withColumn(
            "z_score",
            ratio(
                F.col("daily_return") - F.col("rolling_mean_return_30d"),
                F.col("rolling_volatility_30d"),
            ),
        )

    return over_history(fx, ["series_id"], "rate_date", ROLLING_ROWS, score, chunk_rows)


def is_outlier(threshold: float = Z_SCORE_THRESHOLD) -> Column:
    return F.coalesce(F.abs("z_score") >= threshold, F.lit(False))


def volatility_outliers(scored: DataFrame, threshold: float = Z_SCORE_THRESHOLD) -> DataFrame:
    return scored.where(is_outlier(threshold))


def volatility_report(
    fx: DataFrame, threshold: float = Z_SCORE_THRESHOLD, chunk_rows: int | None = None
) -> DataFrame:
    """Outlier days of an FX mart, changes left out."""
    outliers = volatility_outliers(rolling_zscore(fx, chunk_rows), threshold)
    return outliers.drop("change_1d", "change_1w", "change_1m")


def volatility_with_flags(fx: DataFrame) -> DataFrame:
    """The volatility of the two compared pairs, outlier days marked."""
    pairs = rolling_zscore(fx.where(F.col("series_id").isin(*VOLATILITY_PAIRS)))
    return pairs.select(
        "series_id", "rate_date", "rolling_volatility_30d", is_outlier().alias("is_outlier")
    )


# Rates against FX

def rate_fx(
    rate_differential: DataFrame, fx: DataFrame, series_id: str = USD_BRL_SERIES
) -> DataFrame:
    """Policy rates next to one FX series, on the dates both have."""
    spot = fx.where(F.col("series_id") == series_id).select(
        "rate_date",
        F.col("spot_rate").alias("usdbrl_spot_rate"),
        F.col("daily_return").alias("usdbrl_daily_return"),
    )
    return rate_differential.join(spot, "rate_date").select(
        "rate_date", *_RATES, "usdbrl_spot_rate", "usdbrl_daily_return"
    )


def correlation_report(joined: DataFrame) -> DataFrame:
    """Each rate against FX, by level and by change: always four rows.

    Changes run over the rate's own dates within the joined rows, and are set
    against the FX return of the day (the label says spot rate all the same).
    """
    changes = own_date_changes(joined, "rate_date", {r: f"{r}_change" for r in _RATES})
    pairs = []
    for rate in _RATES:
        label = f"{rate} vs usdbrl_spot_rate"
        pairs.append((label, "level", rate, "usdbrl_spot_rate"))
        pairs.append((label, "change", f"{rate}_change", "usdbrl_daily_return"))
    return correlate_pairs(changes, pairs)


def with_low_sample(correlations: DataFrame) -> DataFrame:
    """Mark change rows resting on too few observations."""
    few = (F.col("basis") == "change") & (F.col("observations") < MIN_CHANGE_OBSERVATIONS)
    return correlations.withColumn("low_sample", few)


def recent_differential(rate_differential: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The differential mart from five years before ``as_of`` (today) on."""
    end = F.current_date() if as_of is None else as_of
    return rate_differential.where(F.col("rate_date") >= years_before(end, _REPORT_YEARS))


def filled_policy_rates(rate_differential: DataFrame) -> DataFrame:
    """Gaps filled from the rows given: pass ``recent_differential`` of the mart for
    the five-year chart, so that nothing is carried in from before it."""
    return forward_fill(
        rate_differential, "rate_date", ["usd_policy_rate", "eur_policy_rate", "usd_eur_differential"]
    )


def filled_rate_fx(joined: DataFrame) -> DataFrame:
    columns = ["usd_policy_rate", "usdbrl_spot_rate"]
    return forward_fill(joined.select("rate_date", *columns), "rate_date", columns)


# Headline

def headline(
    rate_differential: DataFrame,
    yield_curve: DataFrame,
    fx: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """The figures of the summary, as one row.

    Each part is a one-row aggregate; stacked and folded, they need no join.
    """
    latest = (
        recent_differential(rate_differential, as_of)
        .where(F.col("usd_eur_differential").isNotNull())
        .agg(F.max_by(F.struct(*rate_differential.columns), "rate_date").alias("latest"))
        .select(
            F.col("latest.rate_date").alias("latest_date"),
            F.col("latest.usd_policy_rate").alias("usd_policy_rate"),
            F.col("latest.eur_policy_rate").alias("eur_policy_rate"),
            F.col("latest.usd_eur_differential").alias("usd_eur_differential"),
        )
    )
    rank = F.struct("trading_days", -F.unix_date("start_date"))
    inversions = (
        inversion_report(yield_curve)
        .agg(
            F.count(F.lit(1)).alias("inversions"),
            F.max_by(F.struct("trading_days", "start_date", "end_date"), rank).alias("longest"),
        )
        .select(
            "inversions",
            F.col("longest.trading_days").alias("longest_trading_days"),
            F.col("longest.start_date").alias("longest_start_date"),
            F.col("longest.end_date").alias("longest_end_date"),
        )
    )
    fed_funds = correlate_pairs(
        rate_fx(rate_differential, fx),
        [("usd_policy_rate", "level", "usd_policy_rate", "usdbrl_spot_rate")],
    ).select(F.col("correlation").alias("usdbrl_level_correlation"))
    outliers = volatility_report(fx).agg(F.count(F.lit(1)).alias("outlier_days"))

    parts = [latest, inversions, fed_funds, outliers]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
