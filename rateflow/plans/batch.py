"""The batch end to end: landed files to written tables.

Each stage writes what the next one reads, so a rerun can start at any of them
and nothing upstream is computed twice. Paths must be reachable by every
executor.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from rateflow.plans.clean import clean_observations, deduplicated, parse_observations, rejected_files
from rateflow.plans.pipeline import build_all, replace_all
from rateflow.schemas import PARSED_OBSERVATIONS, REJECTED_FILES
from rateflow.sources import json_payloads, raw_csv, tables, wide_tables


def landed_observations(
    spark: SparkSession,
    json_path: str | None = None,
    sdmx_paths: Iterable[str] = (),
    archive_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(observations, rejected files)`` of all landed payloads.

    A payload which cannot be parsed is left out and listed, with the reason; so
    is a path that does not exist. The rest go on. ``sdmx_paths`` are directories
    of statistics CSVs, whatever their headings.
    """
    parsed: list[DataFrame] = []
    rejected: list[DataFrame] = [spark.createDataFrame([], REJECTED_FILES)]
    if json_path is not None:
        payloads = json_payloads.read_json_payloads(spark, json_path)
        if payloads is None:
            rejected.append(_missing(spark, json_path))
        else:
            parsed.append(json_payloads.json_observations(payloads))
            rejected.append(json_payloads.rejected_payloads(payloads))
    for path in sdmx_paths:
        landed = raw_csv.land_sdmx_csv(spark, path)
        parsed.append(parse_observations(landed.rows))
        rejected += [landed.rejected, rejected_files(landed.rows)]
    if archive_path is not None:
        unpacked = wide_tables.land_archives(spark, archive_path)
        parsed.append(unpacked.observations)
        rejected.append(unpacked.rejected)
    if not parsed and len(rejected) == 1:
        raise ValueError("no source given")
    empty = spark.createDataFrame([], PARSED_OBSERVATIONS)
    observations = reduce(DataFrame.unionByName, [p.select(PARSED_OBSERVATIONS.names) for p in parsed], empty)
    return observations, reduce(DataFrame.unionByName, rejected)


def _missing(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame([(path, "missing")], REJECTED_FILES)


def run_from_payloads(
    spark: SparkSession,
    work_path: str,
    database: str,
    buckets: int = 8,
    versioned: bool = False,
    **sources: object,
) -> None:
    """Payloads to tables; ``sources`` as for ``landed_observations``.

    ``versioned`` builds beside the tables there are and replaces them in one
    step (``replace_all``); else they are overwritten one by one.
    """
    observations, rejected = landed_observations(spark, **sources)
    rejected.write.mode("overwrite").parquet(f"{work_path}/rejected")
    tables.write_observations(deduplicated(observations), f"{work_path}/processed")
    (replace_all if versioned else build_all)(
        spark,
        tables.read_observations(spark, f"{work_path}/processed"),
        database,
        buckets=buckets,
    )


def run_from_raw_csv(
    spark: SparkSession,
    raw_path: str,
    work_path: str,
    database: str,
    buckets: int = 8,
    versioned: bool = False,
) -> None:
    """Raw CSVs to tables. A file left without rows keeps its dimension row."""
    landed = raw_csv.land_raw_csv(spark, raw_path)
    raw = landed.rows
    landed.rejected.unionByName(rejected_files(raw)).write.mode("overwrite").parquet(f"{work_path}/rejected")
    rejected = spark.read.schema(REJECTED_FILES).parquet(f"{work_path}/rejected")
    tables.write_observations(clean_observations(raw, rejected), f"{work_path}/processed")
    files = raw_csv.list_raw_csv(spark, raw_path).join(rejected, "series_file", "left_anti")
    (replace_all if versioned else build_all)(
        spark,
        tables.read_observations(spark, f"{work_path}/processed"),
        database,
        series_files=files,
        buckets=buckets,
    )
