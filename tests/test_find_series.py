import datetime as dt

import pytest
from pyspark.sql import functions as F

from rateflow.sources import tables

SERIES, DAYS, GROUP_BYTES = 10_000, 8, 32_768


def rows_scanned(df):
    """Rows of the row groups that the scan did not skip."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


@pytest.fixture
def small_groups(spark):
    settings = {"parquet.block.size": GROUP_BYTES, "parquet.dictionary.page.size": 512}
    for name, value in settings.items():
        spark.conf.set(name, str(value))
    yield
    for name in settings:
        spark.conf.unset(name)


def test_one_series_among_many_reads_few_row_groups(spark, tmp_path, small_groups):
    """Files hold ids from the whole range, so only Bloom filters tell them apart."""
    ids = spark.range(SERIES).select(
        (F.col("id") % 10).cast("string").alias("series_file"),
        F.md5(F.col("id").cast("string")).alias("series_id"),
    )
    days = F.explode(F.sequence(F.lit(dt.date(2020, 1, 1)), F.lit(dt.date(2020, 1, DAYS))))
    path = str(tmp_path / "many")
    tables.write_observations(
        ids.withColumn("date", days).withColumn("value", F.dayofmonth("date").cast("double")), path
    )
    wanted = spark.range(4242, 4243).select(F.md5(F.col("id").cast("string"))).first()[0]
    found = tables.find_series(spark, path, [wanted])
    assert [r["value"] for r in found.orderBy("date").collect()] == list(range(1, DAYS + 1))

    read = rows_scanned(found)
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        unfiltered = rows_scanned(tables.find_series(spark, path, [wanted]))
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled")
    assert DAYS <= read < unfiltered
    assert read <= SERIES * DAYS / 40
    assert tables.find_series(spark, path, ["none"]).count() == 0
    assert tables.find_series(spark, path, []).count() == 0
