import math

import pytest
from pyspark.sql import functions as F

from rateflow.functions.calendar import (
    date_key,
    dated_id,
    inclusive_days,
    is_period_label,
    period_headings,
    period_to_date,
    years_before,
)
from rateflow.functions.coercion import FIRST_DAY, LAST_DAY, MAX_DAYS, date_parts, missing_to_null, to_day, to_number
from rateflow.functions.statistics import pearson, ratio


def evaluate(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [row.out for row in df.select("i", expression.alias("out")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["1", " 1.5 ", "1e5", "+1", "1.", ".5", "-2.5E-1", "inf", "-Infinity", "iNf"]
    expected = [1.0, 1.5, 1e5, 1.0, 1.0, 0.5, -0.25, math.inf, -math.inf, math.inf]
    assert evaluate(spark, texts, to_number(F.col("t"))) == expected


def test_what_is_no_number(spark):
    texts = [".", "1,000", "1.5d", "2f", "NaN", "", "  ", "0x10", "1_0", "1e", "True", "NA", None]
    assert evaluate(spark, texts, to_number(F.col("t"))) == [None] * len(texts)


def test_missing_markers(spark):
    texts = ["NA", "null", "", "N/A", "None", "DGS10", " NA"]
    assert evaluate(spark, texts, missing_to_null(F.col("t"))) == [None] * 5 + ["DGS10", " NA"]


def test_days(spark, day):
    texts = ["2024-01-05", "2024-1-5", "2024-03", "2024", "2024-02-29"]
    expected = [day(d) for d in ["2024-01-05", "2024-01-05", "2024-03-01", "2024-01-01", "2024-02-29"]]
    assert evaluate(spark, texts, to_day(F.col("t"))) == expected
    assert evaluate(spark, texts, date_parts(F.col("t"))) == [3, 3, 2, 1, 3]


def test_what_is_no_day(spark):
    texts = [
        "not-a-date", "2024-13-01", "2023-02-29", "2024-01-01 junk", "20240101", "2024-01-01T00",
        "1677-09-21", "2262-04-12", "", None,
    ]
    assert evaluate(spark, texts, to_day(F.col("t"))) == [None] * len(texts)


@pytest.mark.parametrize(
    "label, expected",
    [
        ("2023", "2023-01-01"), ("2023-Q2", "2023-04-01"), ("2023Q4", "2023-10-01"),
        ("2023_q3", "2023-07-01"), ("2023-S1", "2023-01-01"), ("2023-S2", "2023-07-01"),
        ("2023_H2", "2023-07-01"), ("2023h1", "2023-01-01"), ("2023-06", "2023-06-01"),
        ("2023_11", "2023-11-01"), (" 2023 ", "2023-01-01"), ("2023-", "2023-01-01"),
        ("202306", None), ("2023-13", None), ("2023-00", None), ("FREQ", None),
    ],
)
def test_period_labels(spark, day, label, expected):
    found = evaluate(spark, [label], period_to_date(F.col("t")))
    assert found == [expected and day(expected)]


def test_period_headings():
    columns = ["FREQ", "Series", "2023", "2023-Q2", "2023-S1", "1999_h2", "202306", "2023-Q5", "1800", " 2024 "]
    assert period_headings(columns) == ["2023", "2023-Q2", "2023-S1", "1999_h2", "202306", " 2024 "]


def test_period_label_column(spark):
    assert evaluate(spark, ["2023-q2", "2023-Q5", "FREQ"], is_period_label(F.col("t"))) == [True, False, False]


def test_calendar_expressions(spark, day):
    row = spark.createDataFrame(
        [("X", day("2024-02-29"), day("2024-03-01"))], "id STRING, a DATE, b DATE"
    ).select(
        date_key(F.col("a")), dated_id(F.col("id"), F.col("a")), inclusive_days(F.col("a"), F.col("b")),
        years_before(F.col("a"), 5), dated_id(F.lit(None).cast("string"), F.col("a")),
    ).first()
    assert tuple(row) == (20240229, "X_20240229", 2, day("2019-02-28"), None)


def test_ratio_never_raises(spark):
    row = spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0)), ratio(F.lit(None).cast("double"), F.lit(2.0))).first()
    assert tuple(row) == (None, None)


def test_pearson_of_constant_and_single_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, 4.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    row = df.select(pearson(F.col("a"), F.col("b")), pearson(F.col("b"), F.col("c"))).first()
    assert tuple(row) == (None, None)


def test_the_day_bound(day):
    assert (day(LAST_DAY) - day(FIRST_DAY)).days + 1 == MAX_DAYS


def test_days_at_the_bound_and_dates_with_a_time(spark, day):
    texts = ["1677-09-21", "1677-09-22", "2262-04-11", "2262-04-12", "1677", "2262-04", " 2024-01-01 ",
             "2024-01-01 00:00:00", "2024-01-01T10:30", "2024-01-01 x", "2024-1-2"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    found = [tuple(r) for r in df.select(to_day(F.col("t")), date_parts(F.col("t"))).collect()]
    assert [f[0] for f in found] == [
        None, day("1677-09-22"), day("2262-04-11"), None, None, day("2262-04-01"), day("2024-01-01"),
        day("2024-01-01"), day("2024-01-01"), None, day("2024-01-02"),
    ]
    assert [f[1] for f in found[6:9]] == [3, 4, 4]
