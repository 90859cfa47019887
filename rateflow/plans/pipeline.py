"""The whole batch: observations to star tables, staging views and mart tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.operators.quality import table_failures
from rateflow.plans import marts, staging
from rateflow.plans.star import star_schema
from rateflow.sources import versions
from rateflow.sources.tables import save_bucketed, save_table

STAR_TABLES = ["dim_date", "dim_series", "dim_geography", "fact_market_rates", "fact_derivatives"]

# Fixed values: (table, unique columns, columns without NULLs)
DATA_TESTS = [
    ("stg_fx_rates", ["fx_rate_id"], ["fx_rate_id", "rate_date", "series_id", "value"]),
    ("stg_interest_rates", ["interest_rate_id"], ["interest_rate_id", "rate_date", "series_id", "value"]),
    ("stg_yield_curve", ["yield_curve_id"], ["yield_curve_id", "rate_date", "series_id", "maturity", "value"]),
    ("fx_analytics_mart", ["fx_rate_id"], ["fx_rate_id", "rate_date", "series_id", "spot_rate"]),
    ("yield_curve_mart", ["rate_date"], ["rate_date"]),
    ("rate_differential_mart", ["rate_date"], ["rate_date"]),
]


def staging_models(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: staging.staged(star, name) for name in staging.STAGING_MODELS}


def mart_models(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "fx_analytics_mart": marts.fx_analytics_mart(staged["stg_fx_rates"]),
        "yield_curve_mart": marts.yield_curve_mart(staged["stg_yield_curve"]),
        "rate_differential_mart": marts.rate_differential_mart(staged["stg_interest_rates"]),
    }


def build_all(
    spark: SparkSession,
    observations: DataFrame,
    database: str,
    series_files: DataFrame | None = None,
    buckets: int = 8,
) -> None:
    """Write star tables, mart tables and the data tests' result to a database.

    Staging becomes views of the database; the result of the data tests is its
    table ``data_tests``.

    ``observations`` should be a scan of written files: five tables read it.
    The market fact is bucketed by series, so staging and marts window it
    without a shuffle; choose ``buckets`` for about one task's worth each.
    """
    for name, table in star_schema(observations, series_files).items():
        if name == "fact_market_rates":
            save_bucketed(table, f"{database}.{name}", buckets, "series_key", "date_key")
        else:
            save_table(table, f"{database}.{name}")
    staging.create_staging_views(spark, database)
    staged = {name: spark.table(f"{database}.{name}") for name in staging.STAGING_MODELS}
    built = {}
    for name, mart in mart_models(staged).items():
        if name == "fx_analytics_mart":
            save_bucketed(mart, f"{database}.{name}", buckets, "series_id", "rate_date")
        else:
            save_table(mart, f"{database}.{name}")
        built[name] = spark.table(f"{database}.{name}")
    save_table(data_tests({**staged, **built}), f"{database}.data_tests")


class DataTestsFailed(RuntimeError):
    """A build whose declared tests found rows; it was not published."""


def replace_all(
    spark: SparkSession,
    observations: DataFrame,
    name: str,
    series_files: DataFrame | None = None,
    buckets: int = 8,
    keep: int = 2,
) -> str:
    """``build_all`` as a new version of the database ``name``, which becomes the
    current one in one step when all is built and every data test has passed.

    Until then, and if anything fails, readers see the old version whole. Returns
    the version's database.
    """
    versions.create(spark, name)
    database = versions.open_version(spark, name)
    build_all(spark, observations, database, series_files, buckets)
    failed = spark.table(f"{database}.data_tests").where(F.col("failures") > 0)
    found = [f"{r['table_name']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed.collect()]
    if found:
        raise DataTestsFailed("; ".join(found))
    versions.publish(spark, name, database, keep)
    return database


def data_tests(models: dict[str, DataFrame]) -> DataFrame:
    """Failure counts of every declared uniqueness and not-null test."""
    results = [
        table_failures(models[table], table, unique, not_null)
        for table, unique, not_null in DATA_TESTS
    ]
    return reduce(DataFrame.unionByName, results)
