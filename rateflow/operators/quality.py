"""Checks on observations and on tables, as aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

from rateflow.operators.unique import repeated_keys

REQUIRED_COLUMNS = ("date", "value", "series_id")
ROWS_PER_CHUNK = 1 << 16


def check_columns(df: DataFrame) -> None:
    """Raise ValueError for a missing or wrongly typed column; runs no job."""
    missing = sorted(set(REQUIRED_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if not isinstance(df.schema["date"].dataType, (DateType, TimestampType, TimestampNTZType)):
        raise ValueError("'date' column is not a date or timestamp")
    if not isinstance(df.schema["value"].dataType, NumericType):
        raise ValueError("'value' column is not numeric")


def validate_series(
    df: DataFrame, position: str, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Per file: rows, incomplete rows, out-of-order rows, and the verdict.

    ``position`` is the arrival order within a file, a whole number. Rows are
    compared with their predecessor inside chunks of positions, chunks by their
    first and last dates inside chunks of chunks, and these in the whole file: a
    file holding most of the data is spread over many tasks at the first two
    levels, and the third has a row for ``rows_per_chunk`` squared positions.
    """
    check_columns(df)

    def chunk(size: int) -> Column:
        at = F.col(position).cast("decimal(38,0)")
        return at - at % F.lit(size).cast("decimal(38,0)")

    chunked = df.select(
        "series_file",
        chunk(rows_per_chunk**2).alias("_group"),
        chunk(rows_per_chunk).alias("_chunk"),
        F.col(position).alias("_at"),
        "date",
        (F.col("date").isNull() | F.col("value").isNull()).alias("_incomplete"),
    )
    arrival = Window.partitionBy("series_file", "_group", "_chunk").orderBy("_at")
    chunks = (
        chunked.withColumn("_falls", F.lag("date").over(arrival) > F.col("date"))
        .groupBy("series_file", "_group", "_chunk")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("_incomplete").alias("null_rows"),
            F.count_if("_falls").alias("falls"),
            F.min_by("date", "_at").alias("first_date"),
            F.max_by("date", "_at").alias("last_date"),
        )
    )
    for level, inside in (("_chunk", ["series_file", "_group"]), ("_group", ["series_file"])):
        neighbours = Window.partitionBy(*inside).orderBy(level)
        chunks = (
            chunks.withColumn("_falls", F.lag("last_date").over(neighbours) > F.col("first_date"))
            .groupBy(*inside)
            .agg(
                F.sum("rows").alias("rows"),
                F.sum("null_rows").alias("null_rows"),
                (F.sum("falls") + F.count_if("_falls")).alias("falls"),
                F.min_by("first_date", level).alias("first_date"),
                F.max_by("last_date", level).alias("last_date"),
            )
        )
    return (
        chunks.select("series_file", "rows", "null_rows", F.col("falls").alias("order_violations"))
        .withColumn("ok", (F.col("null_rows") == 0) & (F.col("order_violations") == 0))
    )


def table_failures(
    df: DataFrame, table: str, unique: list[str], not_null: list[str]
) -> DataFrame:
    """``(table_name, column_name, test, failures)`` of a table's tests.

    Unique: keys seen more than once, NULL keys not compared. With one unique
    column all tests come from a single grouped pass over the table.
    """
    if len(unique) != 1:
        return unique_failures(df, table, unique).unionByName(not_null_failures(df, table, not_null))
    key = unique[0]
    groups = df.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col(c).isNull()).alias(f"null {i}") for i, c in enumerate(not_null)),
    )
    tests = [("unique", key, F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)))]
    tests += [
        ("not_null", c, F.coalesce(F.sum(f"null {i}"), F.lit(0))) for i, c in enumerate(not_null)
    ]
    counted = groups.agg(
        F.array(
            *(
                F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), n.alias("failures"))
                for t, c, n in tests
            )
        ).alias("tests")
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline("tests"))


def not_null_failures(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """``(table_name, column_name, test, failures)``: all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failures"
    )


def sketched_failures(
    df: DataFrame, table: str, unique: list[str], not_null: list[str]
) -> DataFrame:
    """``table_failures`` for a table whose keys are hardly ever repeated: a byte
    or two of each key is shuffled rather than the key (``repeated_keys``), at the
    cost of a second pass over the key columns."""
    per_column = [
        repeated_keys(df, c)
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit("unique").alias("test"),
            "failures",
        )
        for c in unique
    ]
    nulls = [not_null_failures(df, table, not_null)] if not_null else []
    return reduce(DataFrame.unionByName, [*per_column, *nulls])


def unique_failures(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """``(table_name, column_name, test, failures)``: keys seen more than once.

    NULL keys are not compared.
    """
    per_column = [
        df.where(F.col(c).isNotNull())
        .groupBy(c)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("failures"))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit("unique").alias("test"),
            "failures",
        )
        for c in columns
    ]
    return reduce(DataFrame.unionByName, per_column)
