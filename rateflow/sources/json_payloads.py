"""JSON payloads: ``{"observations": [{"date": .., "value": ..}, ..]}``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.coercion import date_parts, missing_to_null, to_day, to_number
from rateflow.sources.headed_csv import file_stem

PAYLOAD_SCHEMA = "observations ARRAY<STRUCT<date: STRING, value: STRING>>"


def read_json_payloads(spark: SparkSession, path: str) -> DataFrame | None:
    """``(series_file, payload)``, one row per file; the stem names the series, or
    the ``series_file=`` directory. None where there is no such path."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    partitioned = "series_file" in files.columns
    series = F.col("series_file").cast("string") if partitioned else file_stem()
    return files.select(series.alias("series_file"), F.col("value").alias("payload"))


def json_observations(payloads: DataFrame) -> DataFrame:
    """Long observations of all sound payloads; rows without a value drop out."""
    return (
        _parsed(payloads)
        .where(F.col("reason").isNull())
        .select("series_file", F.posexplode("observations").alias("position", "o"))
        .select(
            "series_file",
            F.col("series_file").alias("series_id"),
            to_day(F.col("o.date")).alias("date"),
            to_number(F.col("o.value")).alias("value"),
            F.col("position").cast("bigint").alias("position"),
        )
        .where(F.col("value").isNotNull())
    )


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    """``(series_file, reason)`` of the payloads left out."""
    return _parsed(payloads).where(F.col("reason").isNotNull()).select("series_file", "reason")


def _parsed(payloads: DataFrame) -> DataFrame:
    """Payloads are whole rows, so each is judged on the spot, with no shuffle.

    Exploding an array of one keeps the optimizer from copying the parse into
    every expression which uses its result.
    """
    observations = F.from_json("payload", PAYLOAD_SCHEMA).getField("observations")
    parsed = payloads.select(
        "series_file", F.explode(F.array(observations)).alias("observations")
    )
    dates = F.filter(
        F.transform("observations", lambda o: missing_to_null(o["date"])), _present
    )
    layouts = F.array_distinct(F.transform(dates, date_parts))
    return parsed.withColumn(
        "reason",
        F.when(F.coalesce(F.size("observations"), F.lit(0)) <= 0, "no_observations")
        .when(F.exists(dates, lambda d: to_day(d).isNull()), "bad_date")
        .when(F.size(layouts) > 1, "mixed_date_layouts"),
    )


def _present(value: Column) -> Column:
    return value.isNotNull()
