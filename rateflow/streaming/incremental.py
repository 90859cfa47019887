"""Cleaning raw CSVs as they land: the rows of one run over all files, however
many runs they came in.

A file stream finds the files that no run has seen. Their rows are merged with
the kept ones by position, so that files may land late or out of order, and
written by bucket of the series: a run reads and writes only the buckets that its
files touch. A run that is repeated after a failure sees the same files under the
same batch number and writes the same folder again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.plans.clean import OBSERVATION_KEY, flaws, typed_observations, with_reason
from rateflow.schemas import OBSERVATIONS, REJECTED_FILES
from rateflow.sources.raw_csv import land_raw_csv

BUCKETS = 64
_FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def clean_landed(
    spark: SparkSession,
    raw_path: str,
    state_path: str,
    buckets: int = BUCKETS,
    max_files: int | None = None,
) -> None:
    """Merge the CSVs under ``raw_path`` that no run has seen into the state.

    ``raw_path`` has one ``series_file=`` directory a series, whose part files
    are in order of their numbers (``write_raw_csv``). ``buckets`` is set once
    for a state. ``max_files`` bounds the files merged at a time.
    """

    def merge(files: DataFrame, batch: int) -> None:
        # The names of what has just landed, which the stream holds here too.
        paths = [row["path"] for row in files.collect()]
        if paths:
            _merge(spark, raw_path, paths, state_path, batch, buckets)

    options = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    stream = spark.readStream.format("binaryFile").schema(_FILES).options(**options).load(raw_path)
    (
        stream.select(F.col("_metadata.file_path").alias("path"))
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{state_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def clean_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The clean observations of all files merged so far."""
    kept = _latest(spark, state_path)
    if kept is None:
        return spark.createDataFrame([], OBSERVATIONS)
    rejected = rejected_state(spark, state_path).select("series_file", F.lit(True).alias("rejected"))
    return (
        kept.join(rejected, "series_file", "left")
        .where(F.col("rejected").isNull())
        .select(OBSERVATIONS.names)
    )


def rejected_state(spark: SparkSession, state_path: str) -> DataFrame:
    """``(series_file, reason)`` by all the files merged so far: a bad date that
    lands late rejects its series from then on."""
    try:
        seen = spark.read.parquet(f"{state_path}/flaws")
        headings = spark.read.schema(REJECTED_FILES).parquet(f"{state_path}/headings")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECTED_FILES)
    seen = seen.groupBy("series_file").agg(F.bit_or("seen").alias("seen"))
    reasons = with_reason(seen).where(F.col("reason").isNotNull()).unionByName(
        headings.select("series_file", "reason")
    )
    return reasons.groupBy("series_file").agg(F.min("reason").alias("reason"))


def _merge(
    spark: SparkSession, raw_path: str, paths: list[str], state_path: str, batch: int, buckets: int
) -> None:
    landed = land_raw_csv(spark, paths, basePath=raw_path)
    # Each folder is one write, which Spark commits as a whole.
    landed.rejected.write.mode("overwrite").parquet(f"{state_path}/headings/batch={batch}")
    seen = landed.rows.groupBy("series_file").agg(F.bit_or(flaws(landed.rows)).alias("seen"))
    seen.write.mode("overwrite").parquet(f"{state_path}/flaws/batch={batch}")
    bucket = F.pmod(F.xxhash64("series_file"), F.lit(buckets)).cast("int").alias("bucket")
    fresh = (
        typed_observations(landed.rows)
        .where(F.col("date").isNotNull() & F.col("value").isNotNull())
        .select("*", bucket)
    )
    series = spark.read.parquet(f"{state_path}/flaws/batch={batch}")
    touched = [r["bucket"] for r in series.select(bucket).distinct().collect()]  # at most ``buckets``
    older = _latest(spark, state_path, before=batch, only=touched)
    rows = fresh if older is None else fresh.unionByName(older.select(fresh.columns))
    merged = rows.groupBy("bucket", *OBSERVATION_KEY).agg(
        F.max_by("value", "position").alias("value"), F.max("position").alias("position")
    )
    (
        merged.repartition("bucket")
        .sortWithinPartitions("bucket", *OBSERVATION_KEY)
        .write.partitionBy("bucket")
        .mode("overwrite")
        .parquet(f"{state_path}/observations/batch={batch}")
    )


def _latest(
    spark: SparkSession, state_path: str, before: int | None = None, only: list[int] | None = None
) -> DataFrame | None:
    """The kept rows: each bucket from the last batch that wrote it."""
    root = f"{state_path}/observations"
    try:
        written = spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if "bucket" not in written.columns:  # batches without a row
        return None
    if before is not None:
        written = written.where(F.col("batch") < before)
    if only is not None:
        written = written.where(F.col("bucket").isin(only))
    # A row a bucket, found from folder names and footers.
    last = written.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()
    if not last:
        return None
    folders = [f"{root}/batch={r['batch']}/bucket={r['bucket']}" for r in last]
    return spark.read.option("basePath", root).schema(written.schema).parquet(*folders)

