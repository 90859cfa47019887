import pytest
from pyspark.sql import functions as F

from rateflow.operators import quality
from rateflow.plans.clean import clean_observations, parse_observations, rejected_files


def test_last_copy_of_a_day_is_kept(raw, rows, day):
    found = clean_observations(raw([("A", "2024-01-01", "1.0", "A"), ("A", "2024-01-01", "9.0", "A")]))
    assert rows(found) == [("A", "A", day("2024-01-01"), 9.0)]


def test_series_sharing_a_day_stay_apart(raw, rows):
    found = clean_observations(raw([
        ("F", "2024-01-01", "1.0", "A"), ("F", "2024-01-01", "9.0", "A"),
        ("F", "2024-01-01", "2.0", "B"), ("F", "2024-01-02", "3.0", "A"),
    ]))
    assert [(series, value) for _, series, _, value in rows(found)] == [("A", 9.0), ("A", 3.0), ("B", 2.0)]


def test_incomplete_rows_go_and_missing_ids_are_one_key(raw, rows, day):
    found = clean_observations(raw([
        ("F", None, "1.0", "A"), ("F", "", "1.0", "A"), ("F", "NA", "1.0", "A"),
        ("F", "2024-01-01", ".", "A"), ("F", "2024-01-02", "nan", "A"),
        ("F", "2024-01-03", "3.0", "NA"), ("F", "2024-01-03", "4.0", None),
    ]))
    assert rows(found) == [("F", None, day("2024-01-03"), 4.0)]


def test_a_bad_date_rejects_only_its_file(raw, rows):
    frame = raw([
        ("GOOD", "2024-01-01", "1.0", "GOOD"), ("BAD", "2024-01-01", "1.0", "BAD"),
        ("BAD", "not-a-date", None, "BAD"), ("MIXED", "2024-01", "1.0", "M"), ("MIXED", "2024-01-02", "1.0", "M"),
        ("MONTHLY", "2024-01", "1.0", "MONTHLY"),
    ])
    assert rows(rejected_files(frame)) == [("BAD", "bad_date"), ("MIXED", "mixed_date_layouts")]
    assert [r[0] for r in rows(clean_observations(frame))] == ["GOOD", "MONTHLY"]


def test_parsing_keeps_copies_and_undated_rows(raw, rows):
    frame = raw([("F", "2024-01-01", "1.0", "F"), ("F", "2024-01-01", "2.0", "F"), ("F", None, "3.0", "F")])
    assert sorted(r.value for r in parse_observations(frame).collect()) == [1.0, 2.0, 3.0]


def test_cleaning_is_idempotent_and_ignores_partitioning(raw, rows):
    many = [(f"F{i % 3}", f"2024-0{1 + i % 9}-{1 + i * 7 % 28:02d}", str(i * 37 % 101), f"S{i % 5}") for i in range(2000)]
    once = clean_observations(raw(many))
    shuffled = clean_observations(raw(many).repartition(7, "value"))
    again = clean_observations(once.select(
        "series_file", F.col("date").cast("string"), F.col("value").cast("string"), "series_id",
        F.monotonically_increasing_id().alias("position"),
    ))
    assert rows(once) == rows(shuffled) == rows(again)


def test_rejected_files_join_after_deduplication(raw):
    plan = clean_observations(raw([("A", "2024-01-01", "1.0", "A")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("max_by")


def test_written_rejects_give_the_same_rows(spark, raw, rows, tmp_path):
    many = [(f"F{i % 9}", "bad" if i == 4 else f"2024-01-{1 + i % 28:02d}", str(i), "HOT" if i % 3 else "S") for i in range(500)]
    frame = raw(many)
    rejected_files(frame).write.parquet(str(tmp_path / "rejected"))
    rejected = spark.read.parquet(str(tmp_path / "rejected"))
    broadcast = rows(clean_observations(frame, rejected))
    assert broadcast == rows(clean_observations(frame)) and {r[0] for r in broadcast} == {f"F{i}" for i in range(9) if i != 4}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(clean_observations(frame, rejected)) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# Checks

def _series(spark, rows):
    return spark.createDataFrame(
        [(f, d, v, "S", i) for i, (f, d, v) in enumerate(rows)],
        "series_file STRING, date STRING, value DOUBLE, series_id STRING, position BIGINT",
    ).withColumn("date", F.to_date("date"))


@pytest.mark.parametrize("rows_per_chunk", [1, 2, 1000])
def test_validation_report(spark, rows, rows_per_chunk):
    frame = _series(spark, [
        ("ok", "2024-01-01", 1.0), ("falls", "2024-01-02", 1.0), ("ok", "2024-01-01", 2.0), ("falls", "2024-01-01", 1.0),
        ("ok", "2024-01-03", 3.0), ("falls", "2024-01-05", 1.0), ("nulls", "2024-01-01", None), ("falls", "2024-01-04", 1.0),
        ("nulls", None, 1.0),
    ])
    assert rows(quality.validate_series(frame, "position", rows_per_chunk)) == [
        ("falls", 4, 0, 2, False), ("nulls", 2, 2, 0, False), ("ok", 3, 0, 0, True),
    ]


def test_arrival_order_across_chunks_of_chunks(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 29)]
    days[9], days[10] = days[10], days[9]
    days[4], days[16] = days[16], days[4]
    readings = _series(spark, [("A", day, 1.0) for day in days])
    falls = sum(a > b for a, b in zip(days, days[1:]))
    for size in (2, 3, 1000):
        found = quality.validate_series(readings, "position", rows_per_chunk=size).first()
        assert (found["rows"], found["order_violations"]) == (28, falls)


@pytest.mark.parametrize(
    "columns, message",
    [
        ("date DATE, value DOUBLE", "series_id"),
        ("date STRING, value DOUBLE, series_id STRING", "date"),
        ("date DATE, value STRING, series_id STRING", "numeric"),
    ],
)
def test_column_checks(spark, columns, message):
    with pytest.raises(ValueError, match=message):
        quality.check_columns(spark.createDataFrame([], columns))


def test_table_tests(spark, rows):
    table = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3), ("b", 4)], "k STRING, v INT")
    assert rows(quality.unique_failures(table, "t", ["k", "v"])) == [("t", "k", "unique", 1), ("t", "v", "unique", 0)]
    assert rows(quality.not_null_failures(table, "t", ["k", "v"])) == [("t", "k", "not_null", 2), ("t", "v", "not_null", 1)]
    both = quality.table_failures(table, "t", ["k"], ["k", "v"])
    assert rows(both) == [("t", "k", "not_null", 2), ("t", "k", "unique", 1), ("t", "v", "not_null", 1)]
