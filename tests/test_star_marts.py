import pytest
from pyspark.sql import functions as F

from rateflow import schemas
from rateflow.plans import marts, pipeline, staging
from rateflow.plans.star import dim_date, dim_geography, dim_series, fact_market_rates, star_schema
from rateflow.sources.tables import read_mart


def _files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "series_file STRING")


def _history(series, values, start="2024-01-01"):
    import datetime as dt

    first = dt.date.fromisoformat(start)
    return [(series, series, str(first + dt.timedelta(days=i)), v) for i, v in enumerate(values)]


def test_dim_date(observations, rows, day):
    table = dim_date(observations([
        ("A", "A", "2024-01-06", 1.0), ("A", "A", "2024-01-08", 1.0), ("B", "B", "2024-01-06", 1.0),
        ("A", "A", "2024-12-30", 1.0),
    ]))
    assert table.schema.simpleString() == schemas.DIM_DATE.simpleString()
    assert rows(table) == [
        (20240106, day("2024-01-06"), 2024, 1, 1, 1, True, False),
        (20240108, day("2024-01-08"), 2024, 1, 1, 2, False, True),
        (20241230, day("2024-12-30"), 2024, 4, 12, 1, False, True),
    ]


def test_dim_series_known_and_unknown(spark, rows):
    table = dim_series(_files(spark, ["H.US.5J.A.5J", "DGS10", "EURUSD_SPOT", "DGS10"]))
    assert table.schema.simpleString() == schemas.DIM_SERIES.simpleString()
    assert rows(table) == [
        ("DGS10", "DGS10", "US 10-Year Treasury Yield", "yield", "USD", "fred", "United States", "United States", "N. America", "USD"),
        ("EURUSD_SPOT", "EURUSD_SPOT", "EUR/USD Spot Rate", "fx_rate", "USD", "ecb", "United States", "United States", "N. America", "USD"),
        ("H.US.5J.A.5J", "H.US.5J.A.5J", "H.US.5J.A.5J", "derivatives", None, "bis", "Global", "Global", "Global", None),
    ]


@pytest.mark.parametrize("names, countries", [
    (["DGS10", "DGS2", "DEXBZUS"], ["Brazil", "United States"]), (["DGS10", "EURUSD_SPOT"], ["United States"]),
])
def test_dim_geography(spark, rows, names, countries):
    assert [r[0] for r in rows(dim_geography(dim_series(_files(spark, names))))] == countries


def test_changes_count_rows_not_days(spark, observations, rows):
    obs = observations(_history("DGS10", [float(i * i) for i in range(25)]))
    fact = fact_market_rates(obs, dim_series(obs))
    assert fact.schema.simpleString() == schemas.FACT_MARKET_RATES.simpleString()
    found = rows(fact, "date_key")
    assert found[0][3:] == (0.0, None, None, None)
    assert found[5][3:] == (25.0, 9.0, 25.0, None)
    assert found[21][3:] == (441.0, 41.0, 185.0, 441.0)
    assert rows(fact_market_rates(obs, dim_series(obs), chunk_rows=21), "date_key") == found


def test_changes_stay_within_a_file_and_series(observations, rows):
    obs = observations([
        ("F", "A", "2024-01-01", 1.0), ("F", "B", "2024-01-02", 5.0), ("F", "A", "2024-01-03", 2.0), ("G", "A", "2024-01-04", 9.0),
    ])
    found = rows(fact_market_rates(obs, dim_series(obs)), "date_key")
    assert [r[4] for r in found] == [None, None, 1.0, None]
    assert {r[1] for r in found} == {None}  # no file is named like these series


def test_star_routes_statistics_and_resolves_keys(observations, rows):
    star = star_schema(observations([
        ("DGS10", "DGS10", "2024-01-02", 4.0), ("BIS_OTC_DERIV", "A:1:USD", "2024-01-01", 1.0),
        ("BIS_OTC_DERIV", "B:2:EUR", "2024-01-01", 2.0), ("BIS_FX_TURNOVER", "A:1:USD", "2024-01-01", 3.0),
    ]))
    assert rows(star["fact_derivatives"]) == [
        (20240101, "BIS_FX_TURNOVER", "A:1:USD", 3.0), (20240101, "BIS_OTC_DERIV", "A:1:USD", 1.0), (20240101, "BIS_OTC_DERIV", "B:2:EUR", 2.0),
    ]
    assert rows(star["fact_market_rates"]) == [(20240102, "DGS10", "United States", 4.0, None, None, None)]
    assert [r[0] for r in rows(star["dim_date"])] == [20240101, 20240102]
    assert [r[0] for r in rows(star["dim_series"])] == ["DGS10"]


def test_files_without_clean_rows_keep_their_dimension_row(spark, observations, rows):
    star = star_schema(observations([("DGS10", "DGS10", "2024-01-02", 4.0)]), _files(spark, ["DGS10", "DGS2", "BIS_OTC_DERIV"]))
    assert [r[0] for r in rows(star["dim_series"])] == ["DGS10", "DGS2"]


def test_empty_star_has_all_columns(observations):
    star = star_schema(observations([]))
    expected = [schemas.DIM_DATE, schemas.DIM_SERIES, schemas.DIM_GEOGRAPHY, schemas.FACT_MARKET_RATES, schemas.FACT_DERIVATIVES]
    for name, schema in zip(pipeline.STAR_TABLES, expected):
        assert star[name].columns == schema.names and star[name].count() == 0


@pytest.fixture
def small_star(observations):
    return star_schema(observations(
        _history("DEXBZUS", [5.0, 5.5, 0.0, 5.0]) + _history("EURUSD_SPOT", [1.1])
        + _history("DGS10", [4.0, 4.0], "2024-01-01") + _history("DGS2", [4.5, 3.0], "2024-01-01") + _history("DGS1MO", [5.0], "2024-01-03")
        + _history("FEDFUNDS", [5.25]) + _history("ECB_DEPOSIT_RATE", [4.0, 4.0]) + _history("EURIBOR_3M", [3.9], "2024-01-09")
    ))


def test_staging(small_star, rows, day):
    fx = staging.stg_fx_rates(small_star)
    assert fx.columns == ["fx_rate_id", "rate_date", "series_id", "series_name", "currency", "source", "value", "change_1d", "change_1w", "change_1m"]
    assert rows(fx)[0] == ("DEXBZUS_20240101", day("2024-01-01"), "DEXBZUS", "USD/BRL Exchange Rate", "BRL", "fred", 5.0, None, None, None)
    assert fx.count() == 5 and staging.stg_interest_rates(small_star).count() == 4
    curve = staging.stg_yield_curve(small_star)
    assert curve.columns[3:6] == ["series_name", "maturity", "currency"]
    assert {(r.series_id, r.maturity) for r in curve.collect()} == {("DGS10", "10Y"), ("DGS2", "2Y"), ("DGS1MO", "1M")}


def test_yield_curve_mart(small_star, rows, day):
    assert rows(marts.yield_curve_mart(staging.stg_yield_curve(small_star))) == [
        (day("2024-01-01"), None, 4.5, 4.0, -0.5, True), (day("2024-01-02"), None, 3.0, 4.0, 1.0, False),
        (day("2024-01-03"), 5.0, None, None, None, None),
    ]


def test_rate_differential_mart_keeps_every_date(small_star, rows, day):
    assert rows(marts.rate_differential_mart(staging.stg_interest_rates(small_star))) == [
        (day("2024-01-01"), 5.25, 4.0, 1.25), (day("2024-01-02"), None, 4.0, None), (day("2024-01-09"), None, None, None),
    ]


def test_daily_return_after_zero_is_missing(small_star, rows):
    mart = marts.fx_analytics_mart(staging.stg_fx_rates(small_star)).where("series_id = 'DEXBZUS'")
    assert mart.columns == schemas.FX_ANALYTICS_MART.names
    assert [r.daily_return for r in mart.orderBy("rate_date").collect()] == [None, pytest.approx(0.1), -1.0, None]


def test_volatility_starts_on_the_31st_row(observations):
    values = [1.0 + (i % 4) * 0.1 for i in range(40)]
    staged = staging.stg_fx_rates(star_schema(observations(_history("DEXUSEU", values) + _history("DEXBZUS", values[:30]))))
    for chunk_rows in (None, 30, 33):
        mart = marts.fx_analytics_mart(staged, chunk_rows).orderBy("series_id", "rate_date").collect()
        volatility = [r.rolling_volatility_30d for r in mart if r.series_id == "DEXUSEU"]
        assert volatility[:30] == [None] * 30 and None not in volatility[30:]
        assert all(r.rolling_volatility_30d is None for r in mart if r.series_id == "DEXBZUS")


def test_batch_to_tables(spark, small_star, observations, tmp_path, rows):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS batch LOCATION '{tmp_path}'")
    obs = observations(_history("DGS10", [4.0, 4.1]) + _history("DEXUSEU", [1.0 + i / 100 for i in range(40)]) + _history("BIS_OTC_DERIV", [7.0]))
    for _ in range(2):  # a second run replaces the first
        pipeline.build_all(spark, obs, "batch", buckets=2)
    assert spark.table("batch.fact_market_rates").count() == 42
    assert spark.table("batch.fact_derivatives").count() == 1
    assert spark.table("batch.fx_analytics_mart").where("rolling_volatility_30d IS NOT NULL").count() == 10
    assert spark.table("batch.stg_yield_curve").count() == 2
    assert spark.table("batch.data_tests").where("failures > 0").count() == 0
    curve = read_mart(spark, "batch.yield_curve_mart", ["rate_date", "yield_10y"], ["rate_date"])
    assert [r.yield_10y for r in curve.collect()] == [4.0, 4.1]
    with pytest.raises(FileNotFoundError, match="build the marts first"):
        read_mart(spark, "batch.nothing", ["a"], ["a"])


def test_windows_on_the_bucketed_fact_need_no_shuffle(spark, observations, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}'")
    pipeline.build_all(spark, observations(_history("DEXUSEU", [1.0, 2.0])), "bucketed", buckets=2)
    star = {name: spark.table(f"bucketed.{name}") for name in pipeline.STAR_TABLES}
    mart = marts.fx_analytics_mart(staging.stg_fx_rates(star)).where(F.col("series_id") == "DEXUSEU")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange hashpartitioning" not in plan
    assert "Bucketed: true" in plan and "EqualTo(series_key,DEXUSEU)" in plan


def test_data_tests(small_star, rows):
    staged = pipeline.staging_models(small_star)
    staged["stg_fx_rates"] = staged["stg_fx_rates"].unionByName(staged["stg_fx_rates"].where("series_id = 'EURUSD_SPOT'"))
    results = rows(pipeline.data_tests({**staged, **pipeline.mart_models(staged)}))
    failing = [r for r in results if r[3]]
    assert len(results) == 25
    assert failing == [("fx_analytics_mart", "fx_rate_id", "unique", 1), ("stg_fx_rates", "fx_rate_id", "unique", 1)]
