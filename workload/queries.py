"""Query name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from rateflow.catalog import DERIVATIVE_DATASETS
from rateflow.functions.calendar import is_period_label, period_to_date
from rateflow.functions.coercion import date_parts, missing_to_null, to_day, to_number
from rateflow.operators.deltas import changed_days, refreshed
from rateflow.operators.pairwise import pairwise_correlations
from rateflow.operators.quality import sketched_failures, table_failures, validate_series
from rateflow.operators.windows import add_changes, full_window, over_history, simple_return
from rateflow.plans import clean, marts, pipeline, reports, star
from rateflow.plans.batch import landed_observations
from rateflow.plans.named_queries import run_named
from rateflow.session import scratch_path
from rateflow.sources import json_payloads, raw_csv, tables, versions, wide_tables
from rateflow.streaming import incremental
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Derived doubles to a fixed number of digits, without a negative zero."""
    return df.withColumns({c: _plain_zero(F.round(c, digits)) for c in columns})


def _plain_zero(value: Column) -> Column:
    return F.when(value == 0, F.lit(0.0)).otherwise(value)


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` from a written table, for what several later plans read.

    The given tables are then scanned once, however many dimensions, marts and
    passes a report needs; a lost executor costs a re-read, not a re-run.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def market(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    return written(spark, views.market_observations(spark, sf_dir, monthly), "market")


def star_tables(spark: SparkSession, sf_dir: str, monthly: bool = False) -> dict[str, DataFrame]:
    """The star over market series only, written: what staging and marts are built on."""
    tables_by_name = star.star_schema(market(spark, sf_dir, monthly))
    return {
        name: written(spark, tables_by_name[name], name)
        for name in ("dim_date", "dim_series", "fact_market_rates")
    }


def market_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.star_schema(market(spark, sf_dir))["fact_market_rates"]


def staged(spark: SparkSession, sf_dir: str, monthly: bool = False) -> dict[str, DataFrame]:
    return pipeline.staging_models(star_tables(spark, sf_dir, monthly))


def mart_tables(
    spark: SparkSession, sf_dir: str, *names: str, monthly: bool = False
) -> list[DataFrame]:
    """The named marts, written: reports read them, some several times."""
    models = pipeline.mart_models(staged(spark, sf_dir, monthly))
    return [written(spark, models[name], name) for name in names]


FX, CURVE, DIFFERENTIAL = "fx_analytics_mart", "yield_curve_mart", "rate_differential_mart"


def fx_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not written: its readers here go over it once, in the same sort."""
    return marts.fx_analytics_mart(staged(spark, sf_dir)["stg_fx_rates"])


def joined_rate_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = pipeline.mart_models(staged(spark, sf_dir, monthly=True))
    return reports.rate_fx(models[DIFFERENTIAL], models[FX])


# "Today" of the five-year report: the given tables end in 2001.
AS_OF = "2001-12-31"


# Coercion and cleaning


@query
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_observations(spark, sf_dir)
    return raw.select("position", to_number(F.col("value")).alias("value"))


@query
def coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_observations(spark, sf_dir)
    text = missing_to_null(F.col("date"))
    return raw.select("position", date_parts(text).alias("parts"), to_day(text).alias("date"))


@query
def parse_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_observations(views.raw_observations(spark, sf_dir)).select(
        "position", "series_file", "series_id", "date", "value"
    )


@query
def clean_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_observations(views.raw_observations(spark, sf_dir))


@query
def quarantine_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.rejected_files(views.raw_observations(spark, sf_dir))


@query
def validate_raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.typed_observations(views.raw_observations(spark, sf_dir))
    return validate_series(typed, "position", rows_per_chunk=4096)


# Sources and sinks


@query
def ingest_json_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = views.json_payloads(spark, sf_dir)
    return json_payloads.json_observations(payloads).select(
        "series_file", "series_id", "date", "value"
    )


@query
def ingest_sdmx_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sdmx")
    rates = views.rate_observations(spark, sf_dir)
    (
        rates.select(
            "series_file",
            F.concat(F.lit("KEY,"), "series_id").alias("KEY"),
            F.col("date").cast("string").alias("TIME_PERIOD"),
            F.col("value").cast("string").alias("OBS_VALUE"),
        )
        .write.partitionBy("series_file")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return clean.parse_observations(raw_csv.read_sdmx_csv(spark, path)).select(
        "series_file", "series_id", "date", "value"
    )


@query
def raw_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    raw = views.raw_observations(spark, sf_dir).repartitionByRange("position")
    raw_csv.write_raw_csv(raw, path)
    return clean.clean_observations(raw_csv.read_partitioned_raw_csv(spark, path))


@query
def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSVs that land in three runs, out of order, cleaned run by run."""
    staged_path, path, state = (scratch_path(spark, n) for n in ("staged", "landing", "state"))
    raw = views.raw_observations(spark, sf_dir).repartitionByRange(6, "position")
    raw.sortWithinPartitions("position").select("series_file", "date", "value", "series_id").write.partitionBy(
        "series_file"
    ).option("header", True).csv(staged_path)
    for nth in (2, 0, 1):
        views.land_parts(spark, staged_path, path, nth, of=3)
        incremental.clean_landed(spark, path, state, buckets=8)
    return incremental.clean_state(spark, state)


@query
def processed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    tables.write_observations(views.all_observations(spark, sf_dir), path)
    return tables.read_observations(spark, path)


@query
def processed_partial_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All series saved, then two of them again with other values."""
    path = scratch_path(spark, "series")
    observations = market(spark, sf_dir)
    tables.save_series(observations, path)
    again = observations.where(F.col("series_id").isin("DGS10", "DEXBZUS"))
    tables.save_series(again.withColumn("value", F.col("value") * 2), path)
    return tables.read_observations(spark, path)


@query
def scan_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    tables.write_observations(views.market_observations(spark, sf_dir), path)
    return tables.select_observations(
        tables.read_observations(spark, path),
        ["DGS10", "DEXBZUS", "FEDFUNDS"],
        "1996-01-01",
        "1998-12-31",
    )


@query
def find_one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series out of a directory of very many, and an id that none has."""
    path = scratch_path(spark, "many")
    tables.write_observations(views.supplier_observations(spark, sf_dir), path)
    return tables.find_series(spark, path, ["7", "none"])


@query
def ingest_wide_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = views.derivative_wide(spark, sf_dir)
    long = [
        wide_tables.wide_to_long(wide.where(F.col("dataset") == name), name)
        for name in DERIVATIVE_DATASETS
    ]
    return long[0].unionByName(long[1]).drop("position")


@query
def ingest_wide_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = written(spark, views.derivative_wide(spark, sf_dir), "wide")
    long = []
    for name in DERIVATIVE_DATASETS:
        path = scratch_path(spark, name)
        own = wide.where(F.col("dataset") == name).drop("dataset", "nation")
        own.write.option("header", True).csv(path)
        long.append(wide_tables.read_wide_csv(spark, path, name).drop("position"))
    return reduce(DataFrame.unionByName, long)


@query
def ingest_mixed_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSVs of several layouts in one directory: what is kept, by name, and
    the files set aside."""
    path = scratch_path(spark, "layouts")
    views.landed_layouts(spark, sf_dir, path)
    landed = raw_csv.land_partitioned_raw_csv(spark, path)
    rejected = written(
        spark, landed.rejected.unionByName(clean.rejected_files(landed.rows)), "rejected"
    )
    kept = clean.clean_observations(landed.rows, rejected)
    return kept.unionByName(rejected, allowMissingColumns=True)


@query
def ingest_wide_mixed_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide CSVs in one folder whose headings hold other periods in other orders."""
    periods = views.half_years(spark, sf_dir)
    wide = written(spark, views.derivative_wide(spark, sf_dir), "wide")
    early, late = periods[: len(periods) // 2], periods[len(periods) // 2 :]
    layouts = [["FREQ", "Series", *early], [*reversed(late), "NOTE", "Series", "202306"]]
    long = []
    for name in DERIVATIVE_DATASETS:
        path = scratch_path(spark, name)
        own = wide.where(F.col("dataset") == name).withColumns(
            {"NOTE": F.lit("a, b"), "202306": F.lit(1.0)}
        )
        for columns in layouts:
            own.select(*columns).write.mode("append").option("header", True).csv(path)
        long.append(wide_tables.read_wide_csv(spark, path, name).drop("position"))
    return reduce(DataFrame.unionByName, long)


@query
def quarantine_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound and broken files of every source, and paths that are not there: rows
    a series that were kept, and every reject with its reason."""
    folder = scratch_path(spark, "landed")
    rates = views.rate_observations(spark, sf_dir)
    payloads = views.json_payloads(spark, sf_dir).select(
        "series_file",
        F.when(F.col("series_file") == "DEXJPUS", F.expr("substring(payload, 1, 40)"))
        .otherwise(F.col("payload"))
        .alias("value"),
    )
    payloads.write.partitionBy("series_file").text(f"{folder}/json")
    for series, value in (("DGS2", "OBS_VALUE"), ("DGS10", "OBSERVATION")):
        rates.where(F.col("series_id") == series).select(
            "series_file", F.col("date").cast("string").alias("TIME_PERIOD"), F.col("value").alias(value)
        ).write.partitionBy("series_file").mode("append").option("header", True).csv(f"{folder}/sdmx")
    archives = views.nation_archives(spark, sf_dir).withColumn(
        "content",
        F.when(F.col("series_file") == "NATION_7", F.expr("substring(content, 1, length(content) - 30)"))
        .otherwise(F.col("content")),
    )
    views.landed_files(archives, f"{folder}/zip", ".zip")
    observations, rejected = landed_observations(
        spark,
        json_path=f"{folder}/json",
        sdmx_paths=[f"{folder}/sdmx", f"{folder}/gone"],
        archive_path=f"{folder}/zip",
    )
    kept = observations.groupBy("series_file").agg(F.count("*").alias("n"), F.lit("kept").alias("state"))
    named = rejected.select(
        F.regexp_extract("series_file", "[^/]*$", 0).alias("series_file"),
        F.lit(0).cast("bigint").alias("n"),
        F.split("reason", ":")[0].alias("state"),
    )
    return kept.unionByName(named)


@query
def ingest_zip_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    expanded = wide_tables.expand_archives(views.nation_archives(spark, sf_dir))
    return wide_tables.archive_observations(expanded).drop("position")


@query
def period_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every kind written from order dates, then parsed back."""
    day, kind = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 10
    year = F.year(day).cast("string")
    quarter = F.quarter(day).cast("string")
    half = F.when(F.month(day) <= 6, "1").otherwise("2")
    label = (
        F.when(kind == 0, year)
        .when(kind == 1, F.concat(year, F.lit("-Q"), quarter))
        .when(kind == 2, F.concat(year, F.lit("_q"), quarter))
        .when(kind == 3, F.concat(year, F.lit("Q"), quarter))
        .when(kind == 4, F.concat(year, F.lit("-S"), half))
        .when(kind == 5, F.concat(year, F.lit("_H"), half))
        .when(kind == 6, F.date_format(day, "yyyy-MM"))
        .when(kind == 7, F.date_format(day, "yyyy_MM"))
        .when(kind == 8, F.date_format(day, "yyyyMM"))
        .otherwise(F.concat(F.lit("FREQ"), year))
    )
    return views.table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label")).select(
        "o_orderkey",
        "label",
        is_period_label(F.col("label")).alias("is_period"),
        period_to_date(F.col("label")).alias("date"),
    )


# Star schema


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(views.all_observations(spark, sf_dir))


@query
def dim_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_series(views.market_observations(spark, sf_dir))


@query
def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_geography(star.dim_series(views.market_observations(spark, sf_dir)))


@query
def fact_market_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_fact(spark, sf_dir)


@query
def fact_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_derivatives(views.derivative_observations(spark, sf_dir))


@query
def route_market_derivative(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = written(spark, views.all_observations(spark, sf_dir), "all")
    routed = star.market_observations(observations).withColumn("route", F.lit("market"))
    other = star.derivative_observations(observations).withColumn("route", F.lit("derivative"))
    return (
        routed.unionByName(other)
        .groupBy("route", "series_file")
        .agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))
    )


# Staging and marts


@query
def stg_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)["stg_fx_rates"]


@query
def stg_interest_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)["stg_interest_rates"]


@query
def stg_yield_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)["stg_yield_curve"]


@query
def mart_fx_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.fx_analytics_mart(staged(spark, sf_dir)["stg_fx_rates"])
    return rounded(mart, "rolling_volatility_30d")


@query
def mart_yield_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.yield_curve_mart(staged(spark, sf_dir)["stg_yield_curve"])


@query
def mart_rate_differential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rate_differential_mart(staged(spark, sf_dir)["stg_interest_rates"])


@query
def data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    views_by_name = {
        name: written(spark, view, name) for name, view in staged(spark, sf_dir).items()
    }
    marts_by_name = {
        name: written(spark, mart, name)
        for name, mart in pipeline.mart_models(views_by_name).items()
    }
    return pipeline.data_tests({**views_by_name, **marts_by_name})


@query
def pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch written to catalog tables, then counted from them."""
    database = built_database(spark, sf_dir)
    names = [*pipeline.STAR_TABLES, FX, CURVE, DIFFERENTIAL]
    counts = [
        spark.table(f"{database}.{name}")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("name"), "n")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def built_database(spark: SparkSession, sf_dir: str) -> str:
    """Name of a new database with everything the batch writes."""
    path = scratch_path(spark, "observations")
    tables.write_observations(views.all_observations(spark, sf_dir), path)
    database = f"rateflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    pipeline.build_all(spark, tables.read_observations(spark, path), database)
    return database


@query
def saved_fx_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as its readers see it, from the catalog, in order of its rows."""
    name = f"{built_database(spark, sf_dir)}.{FX}"
    columns = ["series_id", "rate_date", "spot_rate", "daily_return", "change_1m"]
    return tables.read_mart(spark, name, columns, ["series_id", "rate_date"])


@query
def replaced_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart that readers see when a second build has failed its tests."""
    name = f"rateflow_{uuid.uuid4().hex}"
    versions.create(spark, name, scratch_path(spark, name))
    observations = market(spark, sf_dir)
    pipeline.replace_all(spark, observations, name)
    twice = observations.unionByName(observations.withColumn("value", F.col("value") + 1))
    try:
        pipeline.replace_all(spark, twice, name)
    except pipeline.DataTestsFailed:
        pass
    columns = ["series_id", "rate_date", "spot_rate", "daily_return", "change_1m"]
    return tables.read_mart(spark, f"{name}.{FX}", columns, ["series_id", "rate_date"])


@query
def saved_staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging view of the saved database."""
    return spark.table(f"{built_database(spark, sf_dir)}.stg_yield_curve")


@query
def saved_data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the data tests that the build stores."""
    return spark.table(f"{built_database(spark, sf_dir)}.data_tests")


@query
def batch_from_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads and wide tables parsed, deduplicated, written, and built upon."""
    wide = views.derivative_wide(spark, sf_dir)
    parsed = json_payloads.json_observations(views.json_payloads(spark, sf_dir))
    for name in DERIVATIVE_DATASETS:
        long = wide_tables.wide_to_long(wide.where(F.col("dataset") == name), name)
        parsed = parsed.unionByName(long)
    path = scratch_path(spark, "processed")
    tables.write_observations(clean.deduplicated(parsed), path)
    star_by_name = star.star_schema(tables.read_observations(spark, path))
    staged_by_name = pipeline.staging_models(star_by_name)
    mart = pipeline.mart_models(staged_by_name)[FX]
    return rounded(mart, "rolling_volatility_30d")


# Reports


@query
def report_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.inversion_report(*mart_tables(spark, sf_dir, CURVE))


@query
def report_inversions_many_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    curves = written(spark, views.segment_curves(spark, sf_dir), "curves")
    return reports.inversion_report(curves, ["curve_id"])


@query
def report_longest_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.longest_inversion(
        reports.inversion_report(*mart_tables(spark, sf_dir, CURVE))
    )


@query
def report_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = reports.rolling_zscore(fx_mart(spark, sf_dir))
    return rounded(
        scored.select("fx_rate_id", "rolling_volatility_30d", "rolling_mean_return_30d", "z_score"),
        "rolling_volatility_30d", "rolling_mean_return_30d", "z_score",
    )


@query
def report_vol_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    outliers = reports.volatility_report(fx_mart(spark, sf_dir))
    return rounded(outliers, "rolling_volatility_30d", "rolling_mean_return_30d", "z_score").orderBy(
        "rate_date", "series_id"
    )


@query
def volatility_with_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.volatility_with_flags(fx_mart(spark, sf_dir)), "rolling_volatility_30d")


@query
def rate_fx_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_rate_fx(spark, sf_dir)


@query
def report_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = written(spark, joined_rate_fx(spark, sf_dir), "rate_fx")
    report = reports.correlation_report(joined)
    return rounded(reports.with_low_sample(report), "correlation")


@query
def correlations_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rate against the prices of every supplier, in one pass in blocks."""
    rates = written(spark, views.rate_observations(spark, sf_dir), "rates")
    prices = written(spark, views.supplier_observations(spark, sf_dir), "suppliers")
    return rounded(pairwise_correlations(rates, prices), "correlation")


@query
def rates_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = reports.recent_differential(
        *mart_tables(spark, sf_dir, DIFFERENTIAL, monthly=True), F.lit(AS_OF).cast("date")
    )
    return reports.filled_policy_rates(recent)


@query
def rate_fx_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filled_rate_fx(written(spark, joined_rate_fx(spark, sf_dir), "rate_fx"))


@query
def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        reports.headline(
            *mart_tables(spark, sf_dir, DIFFERENTIAL, CURVE, FX, monthly=True),
            F.lit(AS_OF).cast("date"),
        ),
        "usdbrl_level_correlation",
    )


# Named queries


@query
def named_differential_5y(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts_by_name = {DIFFERENTIAL: mart_rate_differential(spark, sf_dir)}
    return run_named(spark, "usd_eur_differential_5y", AS_OF, marts_by_name.get)


@query
def named_volatility_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts_by_name = {FX: fx_mart(spark, sf_dir)}
    result = run_named(spark, "fx_volatility_eur_usd_vs_usd_brl", AS_OF, marts_by_name.get)
    return rounded(result, "rolling_volatility_30d")


@query
def named_volatility_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts_by_name = {FX: fx_mart(spark, sf_dir)}
    result = run_named(spark, "fx_volatility_eur_usd_vs_usd_brl_summary", AS_OF, marts_by_name.get)
    return rounded(result, "avg_volatility_30d", "min_volatility_30d", "max_volatility_30d")


# The order of rows, as a column


@query
def ordered_differential_5y(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = written(spark, mart_rate_differential(spark, sf_dir), DIFFERENTIAL)
    report = run_named(spark, "usd_eur_differential_5y", AS_OF, {DIFFERENTIAL: mart}.get)
    return tables.with_place(report)


@query
def ordered_volatility_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = written(spark, fx_mart(spark, sf_dir), FX)
    report = run_named(spark, "fx_volatility_eur_usd_vs_usd_brl", AS_OF, {FX: mart}.get)
    return tables.with_place(report.select("series_id", "rate_date"))


@query
def ordered_vol_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = written(spark, fx_mart(spark, sf_dir), FX)
    outliers = reports.volatility_report(mart).orderBy("rate_date", "series_id")
    return tables.with_place(outliers.select("rate_date", "series_id"))


@query
def ordered_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = written(spark, views.all_observations(spark, sf_dir), "all")
    by_name = star.star_schema(observations)
    keys = {"dim_date": "date_key", "dim_series": "series_key", "dim_geography": "geography_key"}
    placed = [
        tables.with_place(tables.sorted_dimension(by_name[name], name)).select(
            F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"), "place"
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, placed)


# Windows at scale: many series, and few series cut into chunks


def _rolling(observations: DataFrame, chunk_rows: int | None) -> DataFrame:
    def analytics(rows: DataFrame, window: WindowSpec) -> DataFrame:
        returns = rows.withColumn("daily_return", simple_return("value", window))
        return returns.withColumns({
            "volatility": full_window("daily_return", F.stddev_samp("daily_return"), window, marts.ROLLING_ROWS),
            "mean_return": full_window("daily_return", F.avg("daily_return"), window, marts.ROLLING_ROWS),
        })

    result = over_history(
        observations.drop("series_file"), ["series_id"], "date", marts.ROLLING_ROWS, analytics, chunk_rows
    )
    return rounded(result, "volatility", "mean_return")


@query
def rolling_many_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(views.supplier_observations(spark, sf_dir), None)


@query
def delta_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling figures kept up to date: the former readings lack late days and
    have others wrong, and only the tails from there on are worked out again."""
    rows = written(spark, views.supplier_observations(spark, sf_dir).drop("series_file"), "rows")
    key, day = F.xxhash64("series_id", "date"), F.col("date")
    wrong = (F.pmod(F.xxhash64("series_id"), F.lit(3)) == 0) & (day >= F.lit("2000-06-01").cast("date"))
    former = rows.where(~(wrong & (F.pmod(key, F.lit(50)) == 0))).withColumn(
        "value", F.when(wrong & (F.pmod(key, F.lit(70)) == 1), F.col("value") + 1).otherwise(F.col("value"))
    )
    former = written(spark, former, "former")
    old = written(spark, _rolling(former, None), "old")
    changed = written(spark, changed_days(former, rows, ["series_id"], "date", "value"), "changed")
    return refreshed(
        old, rows, changed, ["series_id"], "date", marts.ROLLING_ROWS, lambda tail: _rolling(tail, None)
    ).rows


@query
def fact_many_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table where the series dimension grows with the data."""
    observations = written(spark, views.supplier_observations(spark, sf_dir), "suppliers")
    return star.fact_market_rates(observations, star.dim_series(observations))


@query
def rolling_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(views.fx_observations(spark, sf_dir), 500)


@query
def changes_with_infinite_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes and returns over prices of which some are infinite: NULL, never NaN."""
    prices = views.supplier_observations(spark, sf_dir).withColumn(
        "value", F.when(F.dayofyear("date") % 5 < 2, F.lit(float("inf"))).otherwise(F.col("value"))
    )

    def derived(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumn("daily_return", simple_return("value", window))

    changed = add_changes(prices, ["series_id"], "date", "value", {"change_1d": 1})
    result = over_history(changed, ["series_id"], "date", 1, derived)
    return rounded(result.select("series_id", "date", "change_1d", "daily_return"), "daily_return")


@query
def table_tests_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tests of a table over one that has repeated keys and NULLs."""
    flawed = views.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("key"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("quantity"),
    )
    return table_failures(flawed, "lineitem", ["key"], ["key", "quantity"])


@query
def sketched_table_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tests with keys reduced to slots: a key that is unique in its
    table, and one that is not."""
    flawed = views.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("key"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("quantity"),
    )
    orders = views.table(spark, sf_dir, "orders")
    return sketched_failures(flawed, "lineitem", ["key"], ["key", "quantity"]).unionByName(
        sketched_failures(orders, "orders", ["o_orderkey"], ["o_custkey"])
    )


@query
def changes_many_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = views.supplier_observations(spark, sf_dir).drop("series_file")
    return add_changes(observations, ["series_id"], "date", "value", star.CHANGE_LAGS)


@query
def changes_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = views.fx_observations(spark, sf_dir).drop("series_file")
    return add_changes(observations, ["series_id"], "date", "value", star.CHANGE_LAGS, 500)
