"""Observation files and catalog tables: sinks, scans, mart readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow import catalog
from rateflow.functions.coercion import nan_to_null
from rateflow.schemas import OBSERVATIONS
from rateflow.session import scratch_path
from rateflow.sources import versions


#: Row groups say which series they may hold, also where a file's ids are too many
#: for a dictionary and its least and greatest say nothing. Sized by what they hold.
_SERIES_FILTERS = {
    "parquet.bloom.filter.enabled#series_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def write_observations(observations: DataFrame, path: str) -> None:
    """Parquet sorted by series and date over all files.

    Range partitioning evens out files whatever the mix of series, and the
    row-group statistics then answer series and date filters.
    """
    order = ["series_file", "series_id", "date"]
    (
        observations.select(OBSERVATIONS.names)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .options(**_SERIES_FILTERS)
        .parquet(path)
    )


def save_series(observations: DataFrame, path: str) -> None:
    """Replace the series files in ``observations``; others stay as they are.

    One directory a series file. Only the directories of the files given are
    overwritten, when all their data are written; theirs is a range of tasks, so
    a file may be large. Rows inside are sorted, so that row groups are skipped by
    series and date as in ``write_observations``. A directory of that flat layout
    is refused. A file without rows is not touched.
    """
    spark = observations.sparkSession
    if _layout(spark, path) == "flat":
        raise ValueError(f"{path}: not a directory of series, written as a whole")
    order = ["series_file", "series_id", "date"]
    (
        observations.select(OBSERVATIONS.names)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.partitionBy("series_file")
        .option("partitionOverwriteMode", "dynamic")
        .options(**_SERIES_FILTERS)
        .mode("overwrite")
        .parquet(path)
    )


def _layout(spark: SparkSession, path: str) -> str | None:
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if "series_file" in files.columns:
        return "series"
    return None if files.select("path").isEmpty() else "flat"


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """All cleaned series; a missing directory is an empty frame."""
    try:
        scan = spark.read.schema(OBSERVATIONS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], OBSERVATIONS)
    return scan.withColumn("value", nan_to_null(F.col("value"))).select(OBSERVATIONS.names)


def find_series(spark: SparkSession, path: str, series_ids: list[str]) -> DataFrame:
    """All observations of the named series, catalogued or not.

    Among many series only row groups that may hold one of them are read: by their
    least and greatest id, their dictionary, or their Bloom filter. An unknown id has
    no rows, and no ids are no rows.
    """
    return read_observations(spark, path).where(F.col("series_id").isin(series_ids))


def select_observations(
    observations: DataFrame,
    series_ids: list[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """The given (default: all catalogued) series between two days, inclusive.

    Both filters reach the Parquet scan.
    """
    known = catalog.catalog_ids()
    unknown = sorted(set(series_ids or []) - set(known))
    if unknown:
        raise ValueError(f"unknown series: {unknown}")
    start = F.lit(start_date or catalog.DEFAULT_START_DATE).cast("date")
    chosen = observations.where(F.col("series_id").isin(series_ids or known)).where(
        F.col("date") >= start
    )
    if end_date is not None:
        chosen = chosen.where(F.col("date") <= F.lit(end_date).cast("date"))
    return chosen


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str, sort_key: str) -> None:
    """A table on which joins and windows by ``key`` need no shuffle.

    The rebalance hint lets AQE split a bucket that outgrows one task.
    """
    (
        df.hint("rebalance", buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(sort_key)
        .saveAsTable(name)
    )


def read_mart(spark: SparkSession, name: str, columns: list[str], order_by: list[str]) -> DataFrame:
    """Named columns of a mart, ordered; a clear error where it is not built.

    ``name`` may be one in a database of versions: that of its current one.
    """
    name = versions.resolved(spark, name)
    if not spark.catalog.tableExists(name):
        raise FileNotFoundError(f"table {name} not found: build the marts first")
    return spark.table(name).select(*columns).orderBy(*order_by)


#: The order in which each dimension is shown.
DIMENSION_ORDER = {
    "dim_date": ["full_date"],
    "dim_series": ["series_id"],
    "dim_geography": ["geography_key", "country", "region", "currency_code"],
}


def sorted_dimension(dimension: DataFrame, name: str) -> DataFrame:
    """A dimension in its order, for a report; tables have none."""
    return dimension.orderBy(*(F.col(c).asc_nulls_first() for c in DIMENSION_ORDER[name]))


def with_place(ordered: DataFrame, place: str = "place") -> DataFrame:
    """The rows of an ordered frame with their place in it, from 1.

    Row numbers inside each partition follow on those of the partitions before;
    no row moves. The frame is written once, as another run of the same sort may
    cut its partitions elsewhere.
    """
    spark = ordered.sparkSession
    path = scratch_path(spark, "ordered")
    made = ordered.withColumn("_id", F.monotonically_increasing_id())
    made.write.parquet(path)
    numbered = spark.read.schema(made.schema).parquet(path)
    part = F.shiftright("_id", 33)
    counts = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # A row a partition.
    before = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"),
    )
    within = F.col("_id").bitwiseAND((1 << 33) - 1)
    return (
        numbered.join(F.broadcast(before), part == F.col("_part"))
        .withColumn(place, F.col("_before") + within + 1)
        .drop("_id", "_part", "_before")
    )
