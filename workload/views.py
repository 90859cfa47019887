"""The given tables seen as observations, payloads and archives.

Values are always picked, never averaged, so that two engines agree exactly.
The same views in SQL are in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.operators.dedupe import keep_last

# Which market series each part of the given tables stands for. Two of the six
# flag pairs stay uncatalogued on purpose.
FX_SERIES = {"AO": "DEXBZUS", "AF": "DEXUSEU", "NF": "DEXJPUS", "NO": "EURUSD_SPOT"}
RATE_SERIES = {
    "1-URGENT": "DGS1MO",
    "2-HIGH": "DGS2",
    "3-MEDIUM": "DGS10",
    "4-NOT SPECIFIED": "FEDFUNDS",
    "5-LOW": "ECB_DEPOSIT_RATE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def renamed(code: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(text) for pair in names.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[code], code)


def line_position() -> Column:
    """Order and line number, then price: a fixed-width key, so keep-last can
    hash. Line keys are not unique, and prices have two decimals."""
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(19,0)")
    cents = (F.col("l_extendedprice") * 100 + 0.5).cast("bigint").cast("decimal(12,0)")
    return line * F.lit(10**12).cast("decimal(13,0)") + cents


def last_prices(spark: SparkSession, sf_dir: str, series: list[str]) -> DataFrame:
    """The last price per day of each combination of ``series`` columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        *series,
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("value"),
        line_position().alias("position"),
    )
    return keep_last(lines, [*series, "date"], "value", F.col("position"))


def fx_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat("l_returnflag", "l_linestatus")
    prices = last_prices(spark, sf_dir, ["l_returnflag", "l_linestatus"])
    return _as_files(prices, renamed(code, FX_SERIES))


def supplier_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with a series per supplier: many series."""
    return _as_files(
        last_prices(spark, sf_dir, ["l_suppkey"]), F.col("l_suppkey").cast("string")
    )


def rate_observations(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    """Yields and policy rates. ``monthly`` leaves the Fed Funds rate its first day
    of each month: what correlations over a series' own dates and fills are about."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("position"),
    )
    daily = keep_last(orders, ["o_orderpriority", "date"], "value", F.col("position"))
    names = renamed(F.col("o_orderpriority"), RATE_SERIES)
    if not monthly:
        return _as_files(daily, names)
    sparse = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    period = F.when(sparse, F.trunc("date", "month")).otherwise(F.col("date"))
    first = daily.groupBy("o_orderpriority", period.alias("period")).agg(
        F.min("date").alias("date"), F.min_by("value", "date").alias("value")
    )
    return _as_files(first, names)


def market_observations(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    return fx_observations(spark, sf_dir).unionByName(rate_observations(spark, sf_dir, monthly))


def derivative_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(dataset, nation, series_id, period, value)`` per half-year."""
    day = F.col("o_orderdate").cast("date")
    half = F.when(F.month(day) <= 6, "-S1").otherwise("-S2")
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.when(F.col("n_regionkey") <= 1, "BIS_OTC_DERIV")
            .otherwise("BIS_FX_TURNOVER")
            .alias("dataset"),
            F.col("n_name").alias("nation"),
            F.concat("n_name", F.lit(":"), "c_mktsegment").alias("series_id"),
            F.concat(F.year(day).cast("string"), half).alias("period"),
        )
        .agg(F.max("o_totalprice").alias("value"))
    )


def half_years(spark: SparkSession, sf_dir: str) -> list[str]:
    """Headings of all half-years from the first order to the last: two a year."""
    day = F.col("o_orderdate").cast("date")
    first, last = table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first()
    if first is None:
        return []
    return [f"{year}-S{half}" for year in range(first.year, last.year + 1) for half in (1, 2)]


def derivative_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a column per period, plus a column that is none."""
    cells = [
        F.max(F.when(F.col("period") == p, F.col("value"))).alias(p)
        for p in half_years(spark, sf_dir)
    ]
    return (
        derivative_periods(spark, sf_dir)
        .groupBy("dataset", "nation", F.col("series_id").alias("Series"))
        .agg(F.lit("H").alias("FREQ"), *cells)
    )


def derivative_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, half = F.substring("period", 1, 4).cast("int"), F.substring("period", 7, 1).cast("int")
    return derivative_periods(spark, sf_dir).select(
        F.col("dataset").alias("series_file"),
        "series_id",
        F.make_date(year, half * 6 - 5, F.lit(1)).alias("date"),
        "value",
    )


def all_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_observations(spark, sf_dir).unionByName(
        derivative_observations(spark, sf_dir)
    )


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw texts with missing markers, bad numbers, bad dates.

    The DGS2 file has unparseable dates, the ECB_DEPOSIT_RATE file mixed ones.
    """
    key = F.col("o_orderkey")
    series = renamed(F.col("o_orderpriority"), RATE_SERIES)
    day = F.col("o_orderdate").cast("date")
    date = (
        F.when(key % 23 == 0, F.lit(None))
        .when((series == "DGS2") & (key % 101 == 5), "not-a-date")
        .when((series == "ECB_DEPOSIT_RATE") & (key % 103 == 7), F.date_format(day, "yyyy-MM"))
        .otherwise(day.cast("string"))
    )
    value = (
        F.when(key % 17 == 0, ".")
        .when(key % 19 == 0, "NA")
        .when(key % 29 == 0, "1,000")
        .when(key % 31 == 0, "1.5d")
        .when(key % 37 == 0, " 1.5 ")
        .when(key % 41 == 0, "1e5")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return table(spark, sf_dir, "orders").select(
        series.alias("series_file"),
        date.alias("date"),
        value.alias("value"),
        series.alias("series_id"),
        key.alias("position"),
    )


def json_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per series; a series is bounded by its days."""
    reading = F.struct(F.col("date").cast("string").alias("date"), F.col("value").cast("string").alias("value"))
    return (
        market_observations(spark, sf_dir)
        .groupBy("series_file")
        .agg(F.to_json(F.struct(F.array_sort(F.collect_list(reading)).alias("observations"))).alias("payload"))
    )


def nation_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zipped wide CSV per nation: a fixed handful of series each."""
    header = ["FREQ", "Series", *half_years(spark, sf_dir)]

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        import pandas

        for batch in batches:
            contents = []
            for lines in batch["lines"]:
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("data.csv", "\n".join([",".join(header), *lines]))
                contents.append(buffer.getvalue())
            yield pandas.DataFrame({"series_file": batch["series_file"], "content": contents})

    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in header])
    return (
        derivative_wide(spark, sf_dir)
        .groupBy(F.col("nation").alias("series_file"))
        .agg(F.collect_list(line).alias("lines"))
        .mapInPandas(zipped, "series_file STRING, content BINARY")
    )


def landed_files(files: DataFrame, folder: str, suffix: str) -> None:
    """Write ``(series_file, content)`` as one file each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas
        import pyarrow.fs

        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, content in zip(batch["series_file"], batch["content"]):
                store.create_dir(f"{root}/{name}{suffix}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{root}/{name}{suffix}", compression=None) as file:
                    file.write(bytes(content))
            yield pandas.DataFrame({"n": [len(batch)]})

    files.select("series_file", "content").mapInPandas(write, "n LONG").count()


def land_parts(spark: SparkSession, staged: str, folder: str, nth: int, of: int) -> None:
    """Copy every ``of``-th part file of ``series_file=`` directories to ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(staged)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    name = F.concat(F.lit("series_file="), "series_file", F.lit("/"), F.col("_metadata.file_name"))
    landed_files(files.where(part % of == nth).select(name.alias("series_file"), "content"), folder, "")


def landed_layouts(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The raw observations as CSVs of four layouts in one directory; that of
    FEDFUNDS has no values."""
    raw = raw_observations(spark, sf_dir).repartitionByRange("series_file", "position")
    raw = raw.sortWithinPartitions("series_file", "position")
    layouts = {
        ("DGS1MO", "DGS2"): ["date", "value", "series_id"],
        ("DGS10",): ["series_id", "note", "value", "date"],
        ("ECB_DEPOSIT_RATE",): ["value", "date", "status", "series_id", "note"],
        ("FEDFUNDS",): ["date", "series_id", "note"],
    }
    for names, columns in layouts.items():
        (
            raw.where(F.col("series_file").isin(*names))
            .withColumns({"note": F.lit('a, "b"'), "status": F.lit("A")})
            .select("series_file", *columns)
            .write.partitionBy("series_file")
            .mode("append")
            .option("header", True)
            .option("escape", '"')
            .csv(folder)
        )


def segment_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One yield curve per market segment."""
    quotes = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("curve_id"), F.col("o_orderdate").cast("date").alias("rate_date"))
        .agg(*[
            F.max_by("o_totalprice", F.when(F.col("o_orderpriority") == code, F.col("o_orderkey"))).alias(name)
            for code, name in (("2-HIGH", "yield_2y"), ("3-MEDIUM", "yield_10y"))
        ])
    )
    spread = F.col("yield_10y") - F.col("yield_2y")
    return quotes.withColumns({"spread_2y_10y": spread, "is_inverted": spread < 0})


def _as_files(df: DataFrame, series: Column) -> DataFrame:
    named = df.select(series.alias("series_id"), "date", "value")
    return named.select(F.col("series_id").alias("series_file"), "series_id", "date", "value")
