import datetime as dt

import pytest
from pyspark.sql import functions as F

from rateflow import schemas
from rateflow.plans import reports
from rateflow.plans.marts import fx_analytics_mart
from rateflow.plans.named_queries import run_all_named, run_named
from rateflow.plans.staging import stg_fx_rates
from rateflow.plans.star import star_schema


# Inversions

@pytest.fixture
def curve(spark, day):
    def build(entries):
        return spark.createDataFrame(
            [(day(d), None, None, None, s, None if s is None else s < 0) for d, s in entries], schemas.YIELD_CURVE_MART
        )

    return build


def test_no_inversion(curve):
    report = reports.inversion_report(curve([("2024-01-01", 0.1), ("2024-01-02", None)]))
    assert report.columns == schemas.INVERSION_REPORT.names and report.count() == 0


def test_one_inversion(curve, rows, day):
    report = reports.inversion_report(curve([("2024-01-01", -0.1), ("2024-01-02", -0.3), ("2024-01-03", -0.2)]))
    assert report.schema.simpleString() == schemas.INVERSION_REPORT.simpleString()
    assert rows(report) == [(day("2024-01-01"), day("2024-01-03"), 3, 3, -0.3)]


@pytest.mark.parametrize("spreads, periods", [
    ([-1.0, 1.0, -1.0, -1.0], 2), ([None, -1.0], 1), ([-1.0, None, -1.0], 2), ([-1.0, 0.0], 1),
])
def test_breaks(curve, spreads, periods):
    entries = [(f"2024-01-0{i + 1}", s) for i, s in enumerate(spreads)]
    assert reports.inversion_report(curve(entries)).count() == periods


def test_a_weekend_does_not_break_a_run(curve, rows):
    report = reports.inversion_report(curve([("2024-01-05", -0.1), ("2024-01-08", -0.2)]))
    assert [r[2:4] for r in rows(report)] == [(4, 2)]


def test_runs_over_years(curve, rows, day):
    report = reports.inversion_report(curve([
        ("2020-12-31", -0.1), ("2021-06-01", -0.5), ("2023-01-01", -0.2), ("2023-12-31", 0.1),
        ("2024-01-01", -0.1), ("2024-12-31", None), ("2025-01-01", -0.1),
    ]))
    assert rows(report) == [
        (day("2020-12-31"), day("2023-01-01"), 732, 3, -0.5), (day("2024-01-01"), day("2024-01-01"), 1, 1, -0.1),
        (day("2025-01-01"), day("2025-01-01"), 1, 1, -0.1),
    ]


def test_longest_inversion_is_the_first_of_equals(curve, rows, day):
    report = reports.inversion_report(curve([
        ("2024-01-01", -1.0), ("2024-01-02", 1.0), ("2024-01-03", -1.0), ("2024-01-04", -1.0), ("2024-01-05", 1.0),
        ("2024-01-08", -1.0), ("2024-01-09", -1.0),
    ]))
    assert [r[0] for r in rows(reports.longest_inversion(report))] == [day("2024-01-03")]


# Volatility

def _fx(spark, series, returns, volatility=1.0, last_volatility=None):
    start = dt.date(2024, 1, 1)
    entries = []
    for i, value in enumerate(returns):
        vol = last_volatility if last_volatility is not None and i == len(returns) - 1 else volatility
        entries.append((
            f"{series}_{i}", start + dt.timedelta(days=i), series, series, "USD", "fred", 1.0, None, None, None, value, vol,
        ))
    return spark.createDataFrame(entries, schemas.FX_ANALYTICS_MART)


def test_zscore_needs_thirty_rows(spark):
    scored = reports.rolling_zscore(_fx(spark, "A", [0.01] * 29))
    assert scored.where("z_score IS NOT NULL OR rolling_mean_return_30d IS NOT NULL").count() == 0


def test_zscore_value(spark):
    for chunk_rows in (None, 30):
        last = reports.rolling_zscore(_fx(spark, "A", [0.0] * 29 + [0.06]), chunk_rows).orderBy(F.desc("rate_date")).first()
        assert last.rolling_mean_return_30d == pytest.approx(0.002) and last.z_score == pytest.approx(0.058)


def test_zero_volatility_has_no_zscore(spark):
    scored = reports.rolling_zscore(_fx(spark, "A", [0.0] * 29 + [0.06], last_volatility=0.0))
    assert scored.where("z_score IS NOT NULL").count() == 0


def test_series_do_not_leak(spark):
    scored = reports.rolling_zscore(_fx(spark, "A", [0.01] * 35).union(_fx(spark, "B", [0.01] * 10)))
    assert scored.where("series_id = 'B' AND rolling_mean_return_30d IS NOT NULL").count() == 0
    assert scored.where("series_id = 'A' AND rolling_mean_return_30d IS NOT NULL").count() == 6


@pytest.mark.parametrize("threshold, found", [(3.0, 1), (3.3833, 1), (3.4, 0)])
def test_outlier_threshold(spark, threshold, found):
    report = reports.volatility_report(_fx(spark, "A", [0.0] * 29 + [3.5]), threshold)
    assert report.count() == found
    assert report.columns == [
        "fx_rate_id", "rate_date", "series_id", "series_name", "currency", "source", "spot_rate", "daily_return",
        "rolling_volatility_30d", "rolling_mean_return_30d", "z_score",
    ]


def test_flagged_pairs(spark, rows):
    fx = _fx(spark, "DEXUSEU", [0.0] * 29 + [3.5]).union(_fx(spark, "DEXJPUS", [0.0] * 29 + [3.5]))
    flagged = reports.volatility_with_flags(fx)
    assert {r.series_id for r in flagged.collect()} == {"DEXUSEU"}
    assert [r.is_outlier for r in flagged.orderBy("rate_date").collect()] == [False] * 29 + [True]


# Rates against FX

def _rate_fx(spark, usd, differential, spot, returns):
    start = dt.date(2024, 1, 1)
    entries = [(start + dt.timedelta(days=i), *cells) for i, cells in enumerate(zip(usd, differential, spot, returns))]
    return spark.createDataFrame(
        entries,
        "rate_date DATE, usd_policy_rate DOUBLE, usd_eur_differential DOUBLE, usdbrl_spot_rate DOUBLE, usdbrl_daily_return DOUBLE",
    )


def _report(frame):
    return {(r.pair.split()[0], r.basis): (r.correlation, r.observations) for r in reports.correlation_report(frame).collect()}


def test_level_and_change_may_differ(spark):
    rate = [1.0, 1.5, 3.0, 3.2, 5.0]
    found = _report(_rate_fx(spark, rate, rate, [5.0, 5.3, 5.35, 5.9, 5.95], [None, 0.06, 0.0094, 0.1028, 0.0085]))
    assert found["usd_policy_rate", "level"] == (pytest.approx(0.8796861956326865), 5)
    assert found["usd_policy_rate", "change"] == (pytest.approx(-0.9616429893275574), 4)


def test_constant_change_has_no_correlation(spark):
    found = _report(_rate_fx(spark, [1.0, 2.0, 3.0, 4.0, 5.0], [0.5, 1.5, 2.5, 3.5, 4.5], [5.0, 5.2, 5.1, 5.3, 5.2], [None, 0.02, -0.01, 0.02, -0.01]))
    assert found["usd_policy_rate", "change"] == (None, 4)


def test_change_uses_own_dates(spark):
    usd = [5.25] + [None] * 4 + [5.5] + [None] * 4
    found = _report(_rate_fx(spark, usd, [None] * 10, [5.0 + i / 100 for i in range(10)], [None] + [0.01] * 4 + [0.02] + [0.01] * 4))
    assert found["usd_policy_rate", "change"] == (None, 1)
    assert found["usd_eur_differential", "level"] == (None, 0)


def test_missing_rates_are_not_counted(spark):
    found = _report(_rate_fx(spark, [1.0, None, 3.0, 4.0], [0.5, None, 2.5, 3.5], [5.0, 5.1, 5.2, 5.3], [None, 0.02, 0.02, 0.02]))
    assert found["usd_policy_rate", "level"][1] == 3 and found["usd_policy_rate", "change"][1] == 2


def test_always_four_rows(spark, rows):
    empty = reports.correlation_report(_rate_fx(spark, [], [], [], []))
    assert rows(empty) == [
        (f"{rate} vs usdbrl_spot_rate", basis, None, 0)
        for rate in ("usd_eur_differential", "usd_policy_rate") for basis in ("change", "level")
    ]
    assert [r.low_sample for r in reports.with_low_sample(empty).orderBy("basis", "pair").collect()] == [True, True, False, False]


def test_join_takes_one_series(spark, rows, day):
    differential = spark.createDataFrame([(day("2024-01-02"), 5.25, 3.75, 1.5), (day("2024-01-03"), 5.25, 3.75, 1.5)], schemas.RATE_DIFFERENTIAL_MART)
    quotes = [
        ("1", day("2024-01-02"), "DEXBZUS", "n", "BRL", "fred", 5.0, None, None, None, 0.01, 0.02),
        ("2", day("2024-01-02"), "DEXUSEU", "n", "EUR", "fred", 1.1, None, None, None, 0.05, 0.01),
    ]
    joined = reports.rate_fx(differential, spark.createDataFrame(quotes, schemas.FX_ANALYTICS_MART))
    assert joined.columns == ["rate_date", "usd_policy_rate", "usd_eur_differential", "usdbrl_spot_rate", "usdbrl_daily_return"]
    assert rows(joined) == [(day("2024-01-02"), 5.25, 1.5, 5.0, 0.01)]


def test_filled_rates(spark, rows, day):
    differential = spark.createDataFrame([
        (day("2023-06-01"), None, 1.0, None), (day("2023-12-31"), 5.0, None, None), (day("2024-01-01"), None, None, None), (day("2025-03-01"), None, 2.0, 3.0),
    ], schemas.RATE_DIFFERENTIAL_MART)
    assert [r[1:] for r in rows(reports.filled_policy_rates(differential))] == [
        (None, 1.0, None), (5.0, 1.0, None), (5.0, 1.0, None), (5.0, 2.0, 3.0),
    ]


def test_recent_differential(spark, day):
    differential = spark.createDataFrame([(day(d), 1.0, 1.0, 0.0) for d in ("2019-02-27", "2019-02-28", "2024-02-29")], schemas.RATE_DIFFERENTIAL_MART)
    assert reports.recent_differential(differential, F.lit("2024-02-29").cast("date")).count() == 2
    assert reports.recent_differential(differential).count() <= 1


def test_headline(spark, curve, day):
    differential = spark.createDataFrame([
        (day("2024-01-01"), 5.0, 4.0, 1.0), (day("2024-01-02"), 5.5, 4.0, 1.5), (day("2024-01-03"), 5.5, None, None),
    ], schemas.RATE_DIFFERENTIAL_MART)
    fx = _fx(spark, "DEXBZUS", [0.0] * 29 + [3.5]).withColumn("spot_rate", F.dayofyear("rate_date").cast("double"))
    inversions = curve([("2024-01-01", -0.1), ("2024-01-02", 0.1), ("2024-01-03", -0.1), ("2024-01-04", -0.1)])
    row = reports.headline(differential, inversions, fx, F.lit("2024-12-31").cast("date")).first().asDict()
    assert row.pop("usdbrl_level_correlation") == pytest.approx(0.8660254037844387)
    assert row == {
        "latest_date": day("2024-01-02"), "usd_policy_rate": 5.5, "eur_policy_rate": 4.0, "usd_eur_differential": 1.5,
        "inversions": 2, "longest_trading_days": 2, "longest_start_date": day("2024-01-03"), "longest_end_date": day("2024-01-04"),
        "outlier_days": 1,
    }


# Named queries

def test_unknown_name(spark):
    with pytest.raises(KeyError, match="known.*usd_eur_differential_5y"):
        run_named(spark, "three")


def test_business_queries_on_marts(spark, rows, day):
    differential = spark.createDataFrame([(day("2019-01-01"), 1.0, 1.0, 0.0), (day("2024-01-01"), 5.0, 4.0, 1.0)], schemas.RATE_DIFFERENTIAL_MART)
    fx = _fx(spark, "DEXUSEU", [0.0, 0.1], 2.0).union(_fx(spark, "DEXBZUS", [0.0], None)).union(_fx(spark, "DEXJPUS", [0.0], 1.0))
    marts = {"rate_differential_mart": differential, "fx_analytics_mart": fx}.get
    found = run_all_named(spark, day("2024-06-01"), marts)
    assert rows(found["usd_eur_differential_5y"]) == [(day("2024-01-01"), 5.0, 4.0, 1.0)]
    assert [r.series_id for r in found["fx_volatility_eur_usd_vs_usd_brl"].collect()] == ["DEXBZUS", "DEXUSEU", "DEXUSEU"]
    assert rows(found["fx_volatility_eur_usd_vs_usd_brl_summary"]) == [("DEXBZUS", 0, None, None, None), ("DEXUSEU", 2, 2.0, 2.0, 2.0)]
    assert run_named(spark, "usd_eur_differential_5y", marts=marts).columns == schemas.RATE_DIFFERENTIAL_MART.names


def test_infinite_prices_give_no_nan(spark, rows, day):
    """Two infinite prices, kept as values, make neither NaN nor outlier days."""
    import datetime as dt

    inf = float("inf")
    values = [100.0 + i % 7 for i in range(80)]
    values[40] = values[41] = inf
    start = day("2024-01-01")
    readings = spark.createDataFrame(
        [("DEXUSEU", "DEXUSEU", start + dt.timedelta(i), v) for i, v in enumerate(values)],
        schemas.OBSERVATIONS,
    )
    star = star_schema(readings)
    mart = fx_analytics_mart(stg_fx_rates(star))
    scored = reports.rolling_zscore(mart)
    numbers = ["change_1d", "change_1w", "change_1m", "daily_return", "rolling_volatility_30d",
               "rolling_mean_return_30d", "z_score"]
    bad = " OR ".join(f"isnan({c})" for c in numbers)
    assert scored.where(bad).count() == 0
    assert reports.volatility_report(mart).count() == 0
