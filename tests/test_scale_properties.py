"""Split and plain forms give the same rows, also with one series dominating."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rateflow.operators.carry import forward_fill, own_date_changes
from rateflow.operators.islands import flagged_runs
from rateflow.operators.windows import add_changes, full_window, number_rows, over_history, simple_return

FIRST = dt.date(2015, 1, 1)


def _history(seed, hot_days=2500, series=6, gap=0.3):
    """``(series_id, date, value)``: S0 is long, the others hold a few days."""
    random_ = random.Random(seed)
    rows = []
    for s in range(series):
        days = range(hot_days if s == 0 else random_.randint(1, 60))
        for d in days:
            if random_.random() > gap:
                value = random_.choice([0.0, None]) if random_.random() < 0.02 else random_.uniform(1, 9)
                rows.append((f"S{s}", FIRST + dt.timedelta(days=d), value))
    random_.shuffle(rows)
    return rows


@pytest.fixture(params=[1, 2])
def history(request, spark):
    rows = _history(request.param)
    return spark.createDataFrame(rows, "series_id STRING, date DATE, value DOUBLE").repartition(5)


def test_row_numbers(history):
    plain = number_rows(history, ["series_id"], "date", "n").toPandas().sort_values(["series_id", "date"])
    assert (plain["n"] == plain.groupby("series_id").cumcount()).all()


@pytest.mark.parametrize("chunk_rows", [21, 50, 1000])
def test_chunked_changes(history, rows, chunk_rows):
    lags = {"c1": 1, "c5": 5, "c21": 21}
    plain = add_changes(history, ["series_id"], "date", "value", lags)
    chunked = add_changes(history, ["series_id"], "date", "value", lags, chunk_rows)
    assert rows(chunked, "series_id", "date") == rows(plain, "series_id", "date")


@pytest.mark.parametrize("chunk_rows", [30, 31, 400])
def test_chunked_rolling(history, rows, chunk_rows):
    def analytics(df, window):
        df = df.withColumn("r", simple_return("value", window))
        return df.withColumns({
            "sd": full_window("r", F.stddev_samp("r"), window, 30), "mean": full_window("r", F.avg("r"), window, 30),
        })

    plain = over_history(history, ["series_id"], "date", 30, analytics)
    chunked = over_history(history, ["series_id"], "date", 30, analytics, chunk_rows)
    assert rows(chunked, "series_id", "date") == rows(plain, "series_id", "date")


def test_chunks_must_cover_the_look_back(history):
    with pytest.raises(ValueError, match="at least 21"):
        add_changes(history, ["series_id"], "date", "value", {"c": 21}, chunk_rows=20)


def test_rolling_agrees_with_pandas(history):
    frame = history.where("value <> 0").toPandas().sort_values(["series_id", "date"]).reset_index(drop=True)
    frame["r"] = frame.groupby("series_id")["value"].transform(lambda v: v / v.shift(1) - 1)
    rolling = frame.groupby("series_id")["r"].rolling(30, min_periods=30)
    frame["sd"], frame["mean"] = rolling.std().to_numpy(), rolling.mean().to_numpy()

    def analytics(df, window):
        df = df.withColumn("r", simple_return("value", window))
        return df.withColumns({
            "sd": full_window("r", F.stddev_samp("r"), window, 30), "mean": full_window("r", F.avg("r"), window, 30),
        })

    ours = over_history(history.where("value <> 0"), ["series_id"], "date", 30, analytics, 100)
    ours = ours.toPandas().sort_values(["series_id", "date"]).reset_index(drop=True)
    for column in ("r", "sd", "mean"):
        pd.testing.assert_series_equal(ours[column], frame[column], rtol=1e-9, check_dtype=False)


def _sparse(spark, seed):
    random_ = random.Random(seed)
    entries = []
    for d in range(0, 3000, 3):
        if random_.random() < 0.6:
            entries.append((
                FIRST + dt.timedelta(days=d),
                random_.uniform(0, 5) if random_.random() < 0.03 else None,
                random_.uniform(0, 5) if random_.random() < 0.5 else None,
            ))
    random_.shuffle(entries)
    return spark.createDataFrame(entries, "rate_date DATE, a DOUBLE, b DOUBLE")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forward_fill_agrees_with_pandas(spark, seed):
    frame = _sparse(spark, seed)
    expected = frame.toPandas().sort_values("rate_date").reset_index(drop=True)
    expected[["a", "b"]] = expected[["a", "b"]].ffill()
    ours = forward_fill(frame, "rate_date", ["a", "b"]).toPandas().sort_values("rate_date").reset_index(drop=True)
    pd.testing.assert_frame_equal(ours, expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_own_date_changes_agree_with_pandas(spark, seed):
    frame = _sparse(spark, seed)
    expected = frame.toPandas().sort_values("rate_date").reset_index(drop=True)
    for column in ("a", "b"):
        expected[f"d{column}"] = expected[column].dropna().diff()
    ours = own_date_changes(frame, "rate_date", {"a": "da", "b": "db"})
    ours = ours.toPandas().sort_values("rate_date").reset_index(drop=True)
    pd.testing.assert_frame_equal(ours, expected)


def test_carry_by_key(spark, rows):
    frame = spark.createDataFrame(
        [("x", "2023-12-31", 1.0), ("x", "2024-01-01", None), ("y", "2024-01-01", None), ("y", "2025-01-01", 2.0), (None, "2024-01-01", 3.0), (None, "2026-01-01", None)],
        "k STRING, d STRING, v DOUBLE",
    ).withColumn("d", F.to_date("d"))
    filled = forward_fill(frame, "d", ["v"], ["k"])
    assert [r[2] for r in rows(filled, "k", "d")] == [3.0, 3.0, 1.0, 1.0, None, 2.0]


def _runs(flags):
    """Brute force: ``(start, end, rows)`` index triples of the true runs."""
    found, start = [], None
    for i, flag in enumerate([*flags, False]):
        if flag and start is None:
            start = i
        if not flag and start is not None:
            found.append((start, i - 1, i - start))
            start = None
    return found


@pytest.mark.parametrize("seed, share", [(1, 0.5), (2, 0.98), (3, 1.0), (4, 0.0)])
def test_runs_agree_with_brute_force(spark, seed, share):
    random_ = random.Random(seed)
    entries, expected = [], []
    for curve in ("p", "q", None):
        days = sorted(random_.sample(range(4000), 400))
        dates = [FIRST + dt.timedelta(days=d) for d in days]
        flags = [random_.choice([False, None]) if random_.random() >= share else True for _ in days]
        entries += [(curve, d, f, float(i)) for i, (d, f) in enumerate(zip(dates, flags))]
        expected += [(curve, dates[a], dates[b], n, float(a)) for a, b, n in _runs(flags)]
    random_.shuffle(entries)
    frame = spark.createDataFrame(entries, "curve STRING, d DATE, flag BOOLEAN, m DOUBLE").repartition(4)
    found = flagged_runs(frame, "d", F.col("flag"), {"low": F.col("m")}, ["curve"])
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    flagged = sum(1 for e in entries if e[2])
    assert (found.agg(F.sum("rows")).first()[0] or 0) == flagged


def test_no_plan_sorts_a_whole_history_in_one_task(spark):
    """Without keys, only per-year summaries may meet in a single partition."""
    frame = _sparse(spark, 1)
    for plan in (
        forward_fill(frame, "rate_date", ["a"]),
        flagged_runs(frame, "rate_date", F.col("a") < 1, {"low": F.col("a")}),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        for part in text.split("Exchange SinglePartition")[1:]:
            assert "HashAggregate" in part.splitlines()[1] or "Project" in part.splitlines()[1]
