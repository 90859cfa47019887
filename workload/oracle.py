"""The same queries as ANSI SQL over the given tables, for DuckDB."""

from __future__ import annotations

import re

from rateflow.catalog import SERIES_CATALOG
from rateflow.plans.pipeline import DATA_TESTS
from workload.views import FX_SERIES, RATE_SERIES


def _case(expression: str, names: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in names.items())
    return f"CASE {expression} {whens} ELSE {expression} END"


def _r(expression: str) -> str:
    return f"CASE WHEN round({expression}, 6) = 0 THEN 0.0 ELSE round({expression}, 6) END"


_CATALOG_ROWS = ",\n".join(
    "(" + ", ".join(f"'{cell}'" for cell in row) + ")" for row in SERIES_CATALOG
)
_LINE_KEY = "{'a': l_orderkey, 'b': l_linenumber, 'c': l_extendedprice}"
_W30 = "(PARTITION BY series_id ORDER BY {0} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
_HALF = "CASE WHEN month(o_orderdate) <= 6 THEN {0} ELSE {1} END"

# Named parts; a query gets those it mentions, directly or not.
PARTS: dict[str, str] = {
    "fx_obs": f"""
        SELECT {_case('l_returnflag || l_linestatus', FX_SERIES)} AS series_id,
               CAST(l_shipdate AS DATE) AS date, max({_LINE_KEY}).c AS value
        FROM lineitem GROUP BY 1, 2""",
    "supplier_obs": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS series_id,
               CAST(l_shipdate AS DATE) AS date, max({_LINE_KEY}).c AS value
        FROM lineitem GROUP BY 1, 2""",
    "daily_rates": f"""
        SELECT {_case('o_orderpriority', RATE_SERIES)} AS series_id,
               CAST(o_orderdate AS DATE) AS date, arg_max(o_totalprice, o_orderkey) AS value
        FROM orders GROUP BY 1, 2""",
    "rate_obs": "SELECT * FROM daily_rates",
    "market_obs": "SELECT * FROM fx_obs UNION ALL SELECT * FROM rate_obs",
    "deriv_periods": f"""
        SELECT CASE WHEN n_regionkey <= 1 THEN 'BIS_OTC_DERIV' ELSE 'BIS_FX_TURNOVER' END AS dataset,
               n_name AS nation, n_name || ':' || c_mktsegment AS series_id,
               make_date(year(o_orderdate), {_HALF.format(1, 7)}, 1) AS date,
               max(o_totalprice) AS value
        FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey
        GROUP BY ALL""",
    "all_dates": "SELECT DISTINCT date FROM (SELECT date FROM market_obs UNION ALL SELECT date FROM deriv_periods)",
    "series_catalog": f"""
        SELECT * FROM (VALUES {_CATALOG_ROWS})
        AS t(series_id, series_name, category, currency, country, region, currency_code, source)""",
    "dates": """
        SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_key, date AS full_date,
               CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS BIGINT) AS week,
               isodow(date) >= 6 AS is_weekend, isodow(date) < 6 AS is_business_day
        FROM all_dates""",
    "series": """
        SELECT s.series_id AS series_key, s.series_id, coalesce(c.series_name, s.series_id) AS series_name,
               coalesce(c.category, 'derivatives') AS category, c.currency,
               coalesce(c.source, 'bis') AS source,
               coalesce(c.country, 'Global') AS geography_key, coalesce(c.country, 'Global') AS country,
               coalesce(c.region, 'Global') AS region, c.currency_code
        FROM (SELECT DISTINCT series_id FROM market_obs) s LEFT JOIN series_catalog c USING (series_id)""",
    "changes": """
        SELECT *, value - lag(value, 1) OVER w AS change_1d, value - lag(value, 5) OVER w AS change_1w,
               value - lag(value, 21) OVER w AS change_1m
        FROM market_obs WINDOW w AS (PARTITION BY series_id ORDER BY date)""",
    "market_fact": """
        SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_key, s.series_key, s.geography_key,
               value, change_1d, change_1w, change_1m
        FROM changes LEFT JOIN series s USING (series_id)""",
    "staged": """
        SELECT s.series_id || '_' || strftime(d.full_date, '%Y%m%d') AS id, d.full_date AS rate_date,
               s.series_id, s.series_name, s.currency, s.source, s.category,
               f.value, f.change_1d, f.change_1w, f.change_1m
        FROM market_fact f JOIN series s USING (series_key) JOIN dates d USING (date_key)""",
    "stg_fx": """
        SELECT id AS fx_rate_id, rate_date, series_id, series_name, currency, source, value,
               change_1d, change_1w, change_1m FROM staged WHERE category = 'fx_rate'""",
    "stg_interest": """
        SELECT id AS interest_rate_id, rate_date, series_id, series_name, currency, source, value,
               change_1d, change_1w, change_1m FROM staged WHERE category = 'interest_rate'""",
    "stg_yield": """
        SELECT id AS yield_curve_id, rate_date, series_id, series_name,
               CASE series_id WHEN 'DGS1MO' THEN '1M' WHEN 'DGS2' THEN '2Y' WHEN 'DGS10' THEN '10Y' END AS maturity,
               currency, source, value, change_1d, change_1w, change_1m
        FROM staged WHERE category = 'yield'""",
    "fx_returns": """
        SELECT fx_rate_id, rate_date, series_id, series_name, currency, source, value AS spot_rate,
               change_1d, change_1w, change_1m,
               value / nullif(lag(value) OVER (PARTITION BY series_id ORDER BY rate_date), 0) - 1 AS daily_return
        FROM stg_fx""",
    "fx_mart": f"""
        SELECT *, CASE WHEN count(daily_return) OVER {_W30.format('rate_date')} >= 30
                       THEN stddev_samp(daily_return) OVER {_W30.format('rate_date')} END AS rolling_volatility_30d
        FROM fx_returns""",
    "curve_mart": """
        SELECT rate_date, max(CASE WHEN maturity = '1M' THEN value END) AS yield_1m,
               max(CASE WHEN maturity = '2Y' THEN value END) AS yield_2y,
               max(CASE WHEN maturity = '10Y' THEN value END) AS yield_10y,
               max(CASE WHEN maturity = '10Y' THEN value END) - max(CASE WHEN maturity = '2Y' THEN value END) AS spread_2y_10y,
               (max(CASE WHEN maturity = '10Y' THEN value END) - max(CASE WHEN maturity = '2Y' THEN value END)) < 0 AS is_inverted
        FROM stg_yield GROUP BY rate_date""",
    "diff_mart": """
        SELECT rate_date, max(CASE WHEN series_id = 'FEDFUNDS' THEN value END) AS usd_policy_rate,
               max(CASE WHEN series_id = 'ECB_DEPOSIT_RATE' THEN value END) AS eur_policy_rate,
               max(CASE WHEN series_id = 'FEDFUNDS' THEN value END)
                 - max(CASE WHEN series_id = 'ECB_DEPOSIT_RATE' THEN value END) AS usd_eur_differential
        FROM stg_interest GROUP BY rate_date""",
    "inversions": """
        SELECT min(rate_date) AS start_date, max(rate_date) AS end_date,
               CAST(max(rate_date) - min(rate_date) + 1 AS BIGINT) AS duration_days,
               count(*) AS trading_days, min(spread_2y_10y) AS min_spread_2y_10y
        FROM (SELECT *, rn - row_number() OVER (ORDER BY rate_date) AS g
              FROM (SELECT *, row_number() OVER (ORDER BY rate_date) AS rn FROM curve_mart)
              WHERE is_inverted) GROUP BY g""",
    "scored": f"""
        SELECT *, (daily_return - rolling_mean_return_30d) / nullif(rolling_volatility_30d, 0) AS z_score
        FROM (SELECT *, CASE WHEN count(daily_return) OVER {_W30.format('rate_date')} >= 30
                             THEN avg(daily_return) OVER {_W30.format('rate_date')} END AS rolling_mean_return_30d
              FROM fx_mart)""",
    "rate_fx": """
        SELECT r.rate_date, r.usd_policy_rate, r.usd_eur_differential,
               f.spot_rate AS usdbrl_spot_rate, f.daily_return AS usdbrl_daily_return
        FROM diff_mart r JOIN fx_mart f ON f.rate_date = r.rate_date AND f.series_id = 'DEXBZUS'""",
    "rate_changes": """
        SELECT j.*, u.change AS usd_change, e.change AS diff_change
        FROM rate_fx j
        LEFT JOIN (SELECT rate_date, usd_policy_rate - lag(usd_policy_rate) OVER (ORDER BY rate_date) AS change
                   FROM rate_fx WHERE usd_policy_rate IS NOT NULL) u USING (rate_date)
        LEFT JOIN (SELECT rate_date, usd_eur_differential - lag(usd_eur_differential) OVER (ORDER BY rate_date) AS change
                   FROM rate_fx WHERE usd_eur_differential IS NOT NULL) e USING (rate_date)""",
    "pairs": """
        SELECT 'usd_policy_rate vs usdbrl_spot_rate' AS pair, 'level' AS basis, usd_policy_rate AS x, usdbrl_spot_rate AS y FROM rate_changes
        UNION ALL SELECT 'usd_policy_rate vs usdbrl_spot_rate', 'change', usd_change, usdbrl_daily_return FROM rate_changes
        UNION ALL SELECT 'usd_eur_differential vs usdbrl_spot_rate', 'level', usd_eur_differential, usdbrl_spot_rate FROM rate_changes
        UNION ALL SELECT 'usd_eur_differential vs usdbrl_spot_rate', 'change', diff_change, usdbrl_daily_return FROM rate_changes""",
    "correlations": """
        SELECT pair, basis, CASE WHEN isnan(corr(x, y)) THEN NULL ELSE corr(x, y) END AS correlation,
               count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) AS observations
        FROM pairs GROUP BY pair, basis""",
    "segment_curves": """
        SELECT c_mktsegment AS curve_id, CAST(o_orderdate AS DATE) AS rate_date,
               arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderpriority = '3-MEDIUM')
                 - arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderpriority = '2-HIGH') AS spread
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM') GROUP BY 1, 2""",
    "raw_typed": f"""
        SELECT o_orderkey AS position, {_case('o_orderpriority', RATE_SERIES)} AS series_id,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL
                    WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 101 = 5 THEN 'bad'
                    WHEN o_orderpriority = '5-LOW' AND o_orderkey % 103 = 7 THEN 'month'
                    ELSE 'day' END AS kind,
               CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 THEN NULL
                    WHEN o_orderkey % 37 = 0 THEN 1.5 WHEN o_orderkey % 41 = 0 THEN 100000.0
                    ELSE o_totalprice END AS value,
               CAST(o_orderdate AS DATE) AS day
        FROM orders""",
    "typed": """
        SELECT position, series_id, kind, value,
               CASE kind WHEN 'day' THEN day WHEN 'month' THEN CAST(date_trunc('month', day) AS DATE) END AS date
        FROM raw_typed""",
    "rejects": """
        SELECT series_id AS series_file,
               CASE WHEN bool_or(kind = 'bad') THEN 'bad_date' ELSE 'mixed_date_layouts' END AS reason
        FROM typed GROUP BY series_id
        HAVING bool_or(kind = 'bad') OR (bool_or(kind = 'day') AND bool_or(kind = 'month'))""",
    "sound": "SELECT * FROM typed WHERE series_id NOT IN (SELECT series_file FROM rejects)",
    "cleaned": """
        SELECT series_id AS series_file, series_id, date, arg_max(value, position) AS value
        FROM sound WHERE date IS NOT NULL AND value IS NOT NULL GROUP BY ALL""",
}

_CHANGES = """
    SELECT *, value - lag(value, 1) OVER w AS change_1d, value - lag(value, 5) OVER w AS change_1w,
           value - lag(value, 21) OVER w AS change_1m
    FROM {0} WINDOW w AS (PARTITION BY series_id ORDER BY date)"""
_ROLLING = f"""
    SELECT series_id, date, value, daily_return, {_r('volatility')} AS volatility, {_r('mean_return')} AS mean_return
    FROM (SELECT *, CASE WHEN count(daily_return) OVER {_W30.format('date')} >= 30
                         THEN stddev_samp(daily_return) OVER {_W30.format('date')} END AS volatility,
                 CASE WHEN count(daily_return) OVER {_W30.format('date')} >= 30
                      THEN avg(daily_return) OVER {_W30.format('date')} END AS mean_return
          FROM (SELECT *, value / nullif(lag(value) OVER (PARTITION BY series_id ORDER BY date), 0) - 1 AS daily_return
                FROM {{0}}))"""
_DERIV = "SELECT {0} AS series_file, series_id, date, value FROM deriv_periods"
_FILL = "last_value({0} IGNORE NULLS) OVER (ORDER BY rate_date) AS {0}"
_TEST = "SELECT '{0}' AS table_name, '{1}' AS column_name, '{2}' AS test, count(*) AS failures FROM {3}"


def _data_tests() -> str:
    sources = {
        "stg_fx_rates": "stg_fx", "stg_interest_rates": "stg_interest", "stg_yield_curve": "stg_yield",
        "fx_analytics_mart": "fx_mart", "yield_curve_mart": "curve_mart", "rate_differential_mart": "diff_mart",
    }
    selects = []
    for name, unique, not_null in DATA_TESTS:
        for c in unique:
            repeated = f"(SELECT {c} FROM {sources[name]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            selects.append(_TEST.format(name, c, "unique", repeated))
        for c in not_null:
            selects.append(_TEST.format(name, c, "not_null", f"{sources[name]} WHERE {c} IS NULL"))
    return " UNION ALL ".join(selects)


QUERIES: dict[str, str] = {
    "coerce_numbers": "SELECT position, value FROM typed",
    "coerce_dates": "SELECT position, CAST(CASE kind WHEN 'day' THEN 3 WHEN 'month' THEN 2 WHEN 'bad' THEN 3 END AS INTEGER) AS parts, date FROM typed",
    "parse_observations": "SELECT position, series_id AS series_file, series_id, date, value FROM sound WHERE value IS NOT NULL",
    "clean_keep_last": "SELECT * FROM cleaned",
    "quarantine_bad_files": "SELECT * FROM rejects",
    "validate_raw_series": """
        SELECT series_file, rows, null_rows, falls AS order_violations, null_rows = 0 AND falls = 0 AS ok
        FROM (SELECT series_id AS series_file, count(*) AS rows,
                     count(CASE WHEN date IS NULL OR value IS NULL THEN 1 END) AS null_rows,
                     count(CASE WHEN before > date THEN 1 END) AS falls
              FROM (SELECT *, lag(date) OVER (PARTITION BY series_id ORDER BY position) AS before FROM typed)
              GROUP BY series_id)""",
    "ingest_json_observations": "SELECT series_id AS series_file, series_id, date, value FROM market_obs",
    "ingest_sdmx_csv": "SELECT series_id AS series_file, series_id, date, value FROM rate_obs",
    "raw_csv_round_trip": "SELECT * FROM cleaned",
    "incremental_clean": "SELECT * FROM cleaned",
    "processed_round_trip": f"""
        SELECT series_id AS series_file, series_id, date, value FROM market_obs
        UNION ALL {_DERIV.format('dataset')}""",
    "processed_partial_save": """
        SELECT series_id AS series_file, series_id, date,
            CASE WHEN series_id IN ('DGS10', 'DEXBZUS') THEN value * 2 ELSE value END AS value
        FROM market_obs""",
    "scan_range_filter": """
        SELECT series_id AS series_file, series_id, date, value FROM market_obs
        WHERE series_id IN ('DGS10', 'DEXBZUS', 'FEDFUNDS')
          AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
    "find_one_series": """
        SELECT series_id AS series_file, series_id, date, value FROM supplier_obs
        WHERE series_id = '7'""",
    "ingest_wide_unpivot": _DERIV.format("dataset"),
    "ingest_wide_csv": _DERIV.format("dataset"),
    "ingest_mixed_headings": """
        SELECT series_file, series_id, date, value, NULL AS reason FROM cleaned WHERE series_file <> 'FEDFUNDS'
        UNION ALL SELECT series_file, NULL, NULL, NULL, reason FROM rejects
        UNION ALL VALUES ('FEDFUNDS', NULL, NULL, NULL, 'missing_column:value')""",
    "ingest_wide_mixed_headings": _DERIV.format("dataset"),
    "quarantine_all_sources": """
        SELECT series_id AS series_file, count(*) * CASE series_id WHEN 'DGS2' THEN 2 ELSE 1 END AS n,
            'kept' AS state
        FROM market_obs WHERE series_id <> 'DEXJPUS' GROUP BY series_id
        UNION ALL SELECT nation, count(*), 'kept' FROM deriv_periods WHERE nation <> 'NATION_7' GROUP BY nation
        UNION ALL VALUES ('DEXJPUS', 0, 'no_observations'), ('DGS10', 0, 'missing_column'),
            ('gone', 0, 'missing'), ('NATION_7', 0, 'unreadable')""",
    "ingest_zip_archive": _DERIV.format("nation"),
    "period_labels": f"""
        SELECT o_orderkey, label, kind < 9 AS is_period, date FROM (
            SELECT o_orderkey, kind, CASE kind WHEN 0 THEN y WHEN 1 THEN y || '-Q' || q WHEN 2 THEN y || '_q' || q
                WHEN 3 THEN y || 'Q' || q WHEN 4 THEN y || '-S' || h WHEN 5 THEN y || '_H' || h
                WHEN 6 THEN y || '-' || m WHEN 7 THEN y || '_' || m WHEN 8 THEN y || m ELSE 'FREQ' || y END AS label,
              CAST(CASE WHEN kind = 0 THEN date_trunc('year', d) WHEN kind <= 3 THEN date_trunc('quarter', d)
                   WHEN kind <= 5 THEN make_date(year(d), CASE h WHEN '1' THEN 1 ELSE 7 END, 1)
                   WHEN kind <= 7 THEN date_trunc('month', d) END AS DATE) AS date
            FROM (SELECT o_orderkey, o_orderkey % 10 AS kind, CAST(o_orderdate AS DATE) AS d,
                         strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m,
                         CAST(quarter(o_orderdate) AS VARCHAR) AS q, {_HALF.format("'1'", "'2'")} AS h
                  FROM orders))""",
    "dim_date": "SELECT * FROM dates",
    "dim_series": "SELECT * FROM series",
    "dim_geography": "SELECT DISTINCT geography_key, country, region, currency_code FROM series",
    "fact_market_rates": "SELECT * FROM market_fact",
    "fact_derivatives": """
        SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_key, dataset, series_id, value FROM deriv_periods""",
    "route_market_derivative": """
        SELECT 'market' AS route, series_id AS series_file, count(*) AS n, min(date) AS first, max(date) AS last
        FROM market_obs GROUP BY series_id
        UNION ALL SELECT 'derivative', dataset, count(*), min(date), max(date) FROM deriv_periods GROUP BY dataset""",
    "stg_fx_rates": "SELECT * FROM stg_fx",
    "stg_interest_rates": "SELECT * FROM stg_interest",
    "stg_yield_curve": "SELECT * FROM stg_yield",
    "mart_fx_analytics": f"SELECT * REPLACE ({_r('rolling_volatility_30d')} AS rolling_volatility_30d) FROM fx_mart",
    "batch_from_payloads": f"SELECT * REPLACE ({_r('rolling_volatility_30d')} AS rolling_volatility_30d) FROM fx_mart",
    "mart_yield_curve": "SELECT * FROM curve_mart",
    "mart_rate_differential": "SELECT * FROM diff_mart",
    "data_tests": _data_tests(),
    "pipeline_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n FROM {source}"
        for name, source in [
            ("dim_date", "dates"), ("dim_series", "series"),
            ("dim_geography", "(SELECT DISTINCT geography_key, country, region, currency_code FROM series)"),
            ("fact_market_rates", "market_fact"), ("fact_derivatives", "deriv_periods"),
            ("fx_analytics_mart", "fx_mart"), ("yield_curve_mart", "curve_mart"),
            ("rate_differential_mart", "diff_mart"),
        ]
    ),
    "report_inversions": "SELECT * FROM inversions",
    "report_inversions_many_curves": """
        SELECT curve_id, min(rate_date) AS start_date, max(rate_date) AS end_date,
               CAST(max(rate_date) - min(rate_date) + 1 AS BIGINT) AS duration_days,
               count(*) AS trading_days, min(spread) AS min_spread_2y_10y
        FROM (SELECT *, rn - row_number() OVER (PARTITION BY curve_id ORDER BY rate_date) AS g
              FROM (SELECT *, row_number() OVER (PARTITION BY curve_id ORDER BY rate_date) AS rn FROM segment_curves)
              WHERE spread < 0) GROUP BY curve_id, g""",
    "report_longest_inversion": "SELECT * FROM inversions ORDER BY trading_days DESC, start_date LIMIT 1",
    "report_zscore": f"""
        SELECT fx_rate_id, {_r('rolling_volatility_30d')} AS rolling_volatility_30d,
               {_r('rolling_mean_return_30d')} AS rolling_mean_return_30d, {_r('z_score')} AS z_score FROM scored""",
    "report_vol_outliers": f"""
        SELECT * EXCLUDE (change_1d, change_1w, change_1m) REPLACE (
            {_r('rolling_volatility_30d')} AS rolling_volatility_30d,
            {_r('rolling_mean_return_30d')} AS rolling_mean_return_30d, {_r('z_score')} AS z_score)
        FROM scored WHERE abs(z_score) >= 3""",
    "volatility_with_flags": f"""
        SELECT series_id, rate_date, {_r('rolling_volatility_30d')} AS rolling_volatility_30d,
               coalesce(abs(z_score) >= 3, false) AS is_outlier
        FROM scored WHERE series_id IN ('DEXUSEU', 'DEXBZUS')""",
    "rate_fx_joined": "SELECT * FROM rate_fx",
    "report_correlations": f"""
        SELECT pair, basis, {_r('correlation')} AS correlation, observations,
               basis = 'change' AND observations < 5 AS low_sample FROM correlations""",
    "correlations_all_pairs": f"""
        SELECT left_id, right_id, observations, {_r('r')} AS correlation FROM (
            SELECT a.series_id AS left_id, b.series_id AS right_id, count(*) AS observations,
                CASE WHEN isfinite(corr(a.value, b.value)) THEN corr(a.value, b.value) END AS r
            FROM rate_obs a JOIN supplier_obs b ON a.date = b.date GROUP BY 1, 2)""",
    "rates_ffill": "SELECT rate_date, " + ", ".join(
        _FILL.format(c) for c in ("usd_policy_rate", "eur_policy_rate", "usd_eur_differential"))
        + " FROM diff_mart WHERE rate_date >= CAST(DATE '2001-12-31' - INTERVAL 5 YEAR AS DATE)",
    "rate_fx_ffill": "SELECT rate_date, " + ", ".join(
        _FILL.format(c) for c in ("usd_policy_rate", "usdbrl_spot_rate")) + " FROM rate_fx",
    "headline": f"""
        SELECT (SELECT max(rate_date) FROM diff_mart WHERE usd_eur_differential IS NOT NULL) AS latest_date,
               l.usd_policy_rate, l.eur_policy_rate, l.usd_eur_differential,
               (SELECT count(*) FROM inversions) AS inversions,
               i.trading_days AS longest_trading_days, i.start_date AS longest_start_date, i.end_date AS longest_end_date,
               (SELECT {_r('correlation')} FROM correlations
                WHERE pair = 'usd_policy_rate vs usdbrl_spot_rate' AND basis = 'level') AS usdbrl_level_correlation,
               (SELECT count(*) FROM scored WHERE abs(z_score) >= 3) AS outlier_days
        FROM (SELECT * FROM diff_mart WHERE usd_eur_differential IS NOT NULL ORDER BY rate_date DESC LIMIT 1) l,
             (SELECT * FROM inversions ORDER BY trading_days DESC, start_date LIMIT 1) i""",
    "changes_with_infinite_prices": f"""
        SELECT series_id, date, CASE WHEN NOT isnan(change) THEN change END AS change_1d,
               CASE WHEN NOT isnan(change_of) THEN {_r('change_of')} END AS daily_return
        FROM (SELECT *, value - before AS change, value / nullif(before, 0) - 1 AS change_of
              FROM (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY date) AS before
                    FROM (SELECT series_id, date, CASE WHEN dayofyear(date) % 5 < 2
                                 THEN CAST('inf' AS DOUBLE) ELSE value END AS value FROM supplier_obs)))""",
    "table_tests_with_failures": """
        WITH flawed AS (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS key,
                               CASE WHEN l_quantity > 5 THEN l_quantity END AS quantity FROM lineitem)
        SELECT 'lineitem' AS table_name, 'key' AS column_name, 'unique' AS test, count(*) AS failures
        FROM (SELECT key FROM flawed WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem', 'key', 'not_null', count(*) FROM flawed WHERE key IS NULL
        UNION ALL SELECT 'lineitem', 'quantity', 'not_null', count(*) FROM flawed WHERE quantity IS NULL""",
    "sketched_table_tests": """
        WITH flawed AS (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS key,
                               CASE WHEN l_quantity > 5 THEN l_quantity END AS quantity FROM lineitem)
        SELECT 'lineitem' AS table_name, 'key' AS column_name, 'unique' AS test, count(*) AS failures
        FROM (SELECT key FROM flawed WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem', 'key', 'not_null', count(*) FROM flawed WHERE key IS NULL
        UNION ALL SELECT 'lineitem', 'quantity', 'not_null', count(*) FROM flawed WHERE quantity IS NULL
        UNION ALL SELECT 'orders', 'o_orderkey', 'unique', count(*)
        FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
        UNION ALL SELECT 'orders', 'o_custkey', 'not_null', count(*) FROM orders WHERE o_custkey IS NULL""",
    "replaced_database": "SELECT series_id, rate_date, spot_rate, daily_return, change_1m FROM fx_mart",
    "saved_fx_mart": "SELECT series_id, rate_date, spot_rate, daily_return, change_1m FROM fx_mart",
    "saved_staging_view": "SELECT * FROM stg_yield",
    "saved_data_tests": _data_tests(),
    "named_differential_5y": """
        SELECT * FROM diff_mart
        WHERE rate_date >= CAST(DATE '2001-12-31' - INTERVAL 5 YEAR AS DATE)""",
    "named_volatility_series": f"""
        SELECT series_id, rate_date, {_r('rolling_volatility_30d')} AS rolling_volatility_30d
        FROM fx_mart WHERE series_id IN ('DEXUSEU', 'DEXBZUS')""",
    "named_volatility_summary": f"""
        SELECT series_id, count(rolling_volatility_30d) AS observations,
               {_r('avg(rolling_volatility_30d)')} AS avg_volatility_30d,
               {_r('min(rolling_volatility_30d)')} AS min_volatility_30d,
               {_r('max(rolling_volatility_30d)')} AS max_volatility_30d
        FROM fx_mart WHERE series_id IN ('DEXUSEU', 'DEXBZUS') GROUP BY series_id""",
    "ordered_differential_5y": """
        SELECT *, row_number() OVER (ORDER BY rate_date) AS place FROM diff_mart
        WHERE rate_date >= CAST(DATE '2001-12-31' - INTERVAL 5 YEAR AS DATE)""",
    "ordered_volatility_series": """
        SELECT series_id, rate_date, row_number() OVER (ORDER BY series_id, rate_date) AS place
        FROM fx_mart WHERE series_id IN ('DEXUSEU', 'DEXBZUS')""",
    "ordered_vol_outliers": """
        SELECT rate_date, series_id, row_number() OVER (ORDER BY rate_date, series_id) AS place
        FROM scored WHERE abs(z_score) >= 3""",
    "ordered_dimensions": """
        SELECT 'dim_date' AS dimension, CAST(date_key AS VARCHAR) AS key,
            row_number() OVER (ORDER BY full_date) AS place FROM dates
        UNION ALL SELECT 'dim_series', series_key, row_number() OVER (ORDER BY series_id) FROM series
        UNION ALL SELECT 'dim_geography', geography_key,
            row_number() OVER (ORDER BY geography_key, country, region, currency_code NULLS FIRST)
        FROM (SELECT DISTINCT geography_key, country, region, currency_code FROM series)""",
    "rolling_many_series": _ROLLING.format("supplier_obs"),
    "delta_windows": _ROLLING.format("supplier_obs"),
    "fact_many_series": f"""
        SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_key, series_id AS series_key,
               'Global' AS geography_key, value, change_1d, change_1w, change_1m
        FROM ({_CHANGES.format('supplier_obs')})""",
    "rolling_chunked": _ROLLING.format("fx_obs"),
    "changes_many_series": _CHANGES.format("supplier_obs"),
    "changes_chunked": _CHANGES.format("fx_obs"),
}


# The Fed Funds rate on the first day of each month only, for these alone.
MONTHLY_RATES = """
    SELECT series_id, date, value FROM (
        SELECT *, min(date) OVER (PARTITION BY series_id, year(date), month(date)) AS first_day
        FROM daily_rates)
    WHERE series_id <> 'FEDFUNDS' OR date = first_day"""
MONTHLY = {"rate_fx_joined", "report_correlations", "rates_ffill", "rate_fx_ffill", "headline"}


def oracle_sql() -> dict[str, str]:
    monthly = {**PARTS, "rate_obs": MONTHLY_RATES}
    return {
        name: _with_parts(text, monthly if name in MONTHLY else PARTS)
        for name, text in QUERIES.items()
    }


def _with_parts(text: str, parts_by_name: dict[str, str]) -> str:
    """Prepend the parts a query mentions, in the order they are defined."""
    needed: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"(?:FROM|JOIN)\s+(\w+)", todo.pop()))
        for name in words & (parts_by_name.keys() - needed):
            needed.add(name)
            todo.append(parts_by_name[name])
    parts = ", ".join(f"{name} AS ({parts_by_name[name]})" for name in parts_by_name if name in needed)
    return f"WITH {parts} {text}" if parts else text
