import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.operators.deltas import changed_days, refreshed

DAY = dt.date(2020, 1, 1)
LOOK_BACK = 5


def work(rows):
    window = Window.partitionBy("s").orderBy("d")
    return rows.select(
        "s", "d", "v",
        (F.col("v") - F.lag("v", LOOK_BACK).over(window)).alias("change"),
        F.sum("v").over(window.rowsBetween(-LOOK_BACK, 0)).alias("rolled"),
    )


def frame(spark, readings):
    rows = [(s, DAY + dt.timedelta(days=d), v) for (s, d), v in sorted(readings.items())]
    return spark.createDataFrame(rows, "s STRING, d DATE, v DOUBLE")


@pytest.mark.parametrize("seed", range(4))
def test_same_rows_as_a_rebuild(spark, seed):
    rng = random.Random(seed)
    step = {"A": 1, "B": 1, "C": 40, "D": 3, "E": 1}  # C is sparse
    former = {(s, i * step[s]): float(rng.randint(1, 99)) for s in step for i in range(60)}
    now = dict(former)
    for s in ("A", "C", "D"):
        for i in rng.sample(range(30, 60), 3):
            now[s, i * step[s]] += 1.0  # corrected
        now.pop((s, rng.choice([40, 50, 59]) * step[s]), None)  # taken away
        now[s, 45 * step[s] + (1 if step[s] > 1 else 100)] = 7.0  # late
    now["NEW", 3] = 1.0
    now["B", -5] = 2.0  # before all others
    before, rows = frame(spark, former), frame(spark, now)
    changed = changed_days(before, rows, ["s"], "d", "v")
    made = refreshed(work(before), rows, changed, ["s"], "d", LOOK_BACK, work)
    assert sorted(map(tuple, made.rows.collect()), key=str) == sorted(map(tuple, work(rows).collect()), key=str)
    assert {r["s"] for r in made.redone.collect()} == {"A", "B", "C", "D", "NEW"}
    assert made.kept.where("s = 'E'").count() == 60


def test_nothing_changed(spark):
    rows = frame(spark, {("A", i): 1.0 for i in range(9)})
    changed = changed_days(rows, rows, ["s"], "d", "v")
    made = refreshed(work(rows), rows, changed, ["s"], "d", LOOK_BACK, work)
    assert made.rows.count() == 9 and made.redone.count() == 0


def test_the_scan_of_the_untouched_part_is_pruned(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, {("A", i): float(i) for i in range(400)}).write.parquet(path)
    rows = spark.read.parquet(path)
    changed = frame(spark, {("A", 390): 0.0}).select("s", "d")
    made = refreshed(work(rows), rows, changed, ["s"], "d", LOOK_BACK, work)
    plan = made.redone._jdf.queryExecution().optimizedPlan().toString()
    assert f"d#" in plan and "2021-01-03" in plan  # day 390 less 22
    assert made.redone.count() == 10
