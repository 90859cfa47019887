"""Raw observation CSVs: columns ``date``, ``value`` and ``series_id``, by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.schemas import RAW_OBSERVATIONS, REJECTED_FILES
from rateflow.sources.headed_csv import file_stem, read_headed_csv

_RAW_COLUMNS = ["date", "value", "series_id"]
_SDMX_COLUMNS = ["TIME_PERIOD", "OBS_VALUE"]


@dataclass(frozen=True)
class Landed:
    """``rows`` of texts, and the files left out before any cell was parsed:
    ``(series_file, reason)``. Rows may have a column ``malformed``."""

    rows: DataFrame
    rejected: DataFrame


def land_raw_csv(spark: SparkSession, path: str | list[str], **options: str) -> Landed:
    """All ``<stem>.csv`` files of a directory, whatever else their headings hold
    and in whatever order. A missing directory is an empty frame and listed."""
    return _land(spark, path, pathGlobFilter="*.csv", **options)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``land_raw_csv``."""
    return land_raw_csv(spark, path).rows


def _land(spark: SparkSession, path: str | list[str], **options: str) -> Landed:
    found = read_headed_csv(spark, path, **options)
    if found is None:
        missing = spark.createDataFrame([(str(path), "missing")], REJECTED_FILES)
        return Landed(spark.createDataFrame([], RAW_OBSERVATIONS), missing)
    rows = found.pick(_RAW_COLUMNS).select(*RAW_OBSERVATIONS.names, "malformed")
    return Landed(rows, found.rejected(_RAW_COLUMNS))


def list_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(series_file)`` of every CSV in a directory; contents are not read.

    A missing directory holds none.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "series_file STRING")
    return files.select(file_stem().alias("series_file"))


def write_raw_csv(raw: DataFrame, path: str) -> None:
    """One sub-directory per series file.

    Rows are range-partitioned by file and position: a file is written by the few
    tasks that hold its range, so there are hardly more files than series and
    tasks together, and part files are consecutive.
    """
    (
        raw.repartitionByRange("series_file", "position")
        .sortWithinPartitions("series_file", "position")
        .select("series_file", "date", "value", "series_id")
        .write.partitionBy("series_file")
        .mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def land_partitioned_raw_csv(spark: SparkSession, path: str) -> Landed:
    """CSVs in ``series_file=`` directories; part files count as consecutive."""
    return _land(spark, path)


def read_partitioned_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``land_partitioned_raw_csv``: what ``write_raw_csv`` wrote."""
    return _land(spark, path).rows


def land_sdmx_csv(spark: SparkSession, path: str) -> Landed:
    """Statistics CSVs (``TIME_PERIOD``, ``OBS_VALUE`` and others) as raw texts.

    The series is the file stem, or the ``series_file=`` directory where there
    is one.
    """
    found = read_headed_csv(spark, path)
    if found is None:
        missing = spark.createDataFrame([(path, "missing")], REJECTED_FILES)
        return Landed(spark.createDataFrame([], RAW_OBSERVATIONS), missing)
    rows = found.pick(_SDMX_COLUMNS).select(
        "series_file",
        F.col("TIME_PERIOD").alias("date"),
        F.col("OBS_VALUE").alias("value"),
        F.col("series_file").alias("series_id"),
        "position",
        "malformed",
    )
    return Landed(rows, found.rejected(_SDMX_COLUMNS))


def read_sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``land_sdmx_csv``; an error where no file has observations."""
    found = read_headed_csv(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    complete = F.array_contains("heading", _SDMX_COLUMNS[0]) & F.array_contains("heading", _SDMX_COLUMNS[1])
    if found.headings.where(complete).isEmpty():
        raise ValueError(f"{path}: not an observation CSV, no {_SDMX_COLUMNS}")
    return land_sdmx_csv(spark, path).rows
