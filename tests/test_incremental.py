import pytest
from pyspark.sql import functions as F

from rateflow.plans.clean import clean_observations
from rateflow.sources import raw_csv
from rateflow.streaming import incremental


def land(root, series, part, lines, heading="date,value,series_id"):
    folder = root / f"series_file={series}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{part:05d}-x-c000.csv").write_text(heading + "\n" + "".join(f"{line}\n" for line in lines))


def state(spark, root):
    found = incremental.clean_state(spark, str(root / "state")).collect()
    return sorted((r.series_file, r.series_id, str(r.date), r.value) for r in found)


def one_run(spark, root):
    landed = raw_csv.land_partitioned_raw_csv(spark, str(root / "raw"))
    found = clean_observations(landed.rows).collect()
    return sorted((r.series_file, r.series_id, str(r.date), r.value) for r in found)


def test_three_runs_give_the_rows_of_one(spark, tmp_path):
    raw, run = tmp_path / "raw", lambda: incremental.clean_landed(spark, str(tmp_path / "raw"), str(tmp_path / "state"), buckets=4)
    land(raw, "A", 1, ["2024-01-01,1.0,A", "2024-01-02,2.0,A", "2024-01-02,2.5,A", "2024-01-09,.,A"])
    land(raw, "B", 0, ["2024-01-01,7.0,B"])
    land(raw, "C", 0, ["2024-01-01,1.0,C"])
    run()
    assert state(spark, tmp_path) == one_run(spark, tmp_path)
    # Later: a part with a lower number, a correction, a new series, another heading.
    land(raw, "A", 0, ["2024-01-01,9.0,A", "2024-01-03,3.0,A"])
    land(raw, "B", 1, ["8.0,x,B,2024-01-01", "8.5,x,B,2024-01-02"], "value,note,series_id,date")
    land(raw, "D", 0, ["2024-01-01,4.0,D"])
    run()
    assert state(spark, tmp_path) == one_run(spark, tmp_path)
    assert ("A", "A", "2024-01-01", 1.0) in state(spark, tmp_path)  # part 1 is behind part 0
    # A bad date rejects what was kept before.
    land(raw, "C", 1, ["soon,1.0,C"])
    land(raw, "E", 0, ["2024-01-01"], "date")
    run()
    assert state(spark, tmp_path) == one_run(spark, tmp_path)
    assert sorted(map(tuple, incremental.rejected_state(spark, str(tmp_path / "state")).collect())) == [
        ("C", "bad_date"), ("E", "missing_column:value"),
    ]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "state" / "observations").rglob("*.parquet")}
    run()
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "state" / "observations").rglob("*.parquet")} == before


def test_a_run_writes_the_buckets_it_touches(spark, tmp_path):
    raw = tmp_path / "raw"
    for i in range(12):
        land(raw, f"S{i}", 0, ["2024-01-01,1.0,S"])
    run = lambda: incremental.clean_landed(spark, str(raw), str(tmp_path / "state"), buckets=8)
    run()
    land(raw, "S3", 1, ["2024-01-02,2.0,S"])
    run()
    batches = sorted((tmp_path / "state" / "observations").glob("batch=*"))
    assert len(batches) == 2 and len(list(batches[1].glob("bucket=*"))) == 1
    assert len(state(spark, tmp_path)) == 13


def test_a_run_that_failed_is_taken_up_again(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    land(raw, "A", 0, ["2024-01-01,1.0,A"])
    run = lambda: incremental.clean_landed(spark, str(raw), str(tmp_path / "state"), buckets=2)
    run()
    land(raw, "A", 1, ["2024-01-01,2.0,A"])
    whole = incremental.typed_observations

    def fails(rows):
        raise OSError("lost")

    monkeypatch.setattr(incremental, "typed_observations", fails)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(incremental, "typed_observations", whole)
    assert state(spark, tmp_path) == [("A", "A", "2024-01-01", 1.0)]
    land(raw, "A", 2, ["2024-01-02,3.0,A"])
    run()
    assert state(spark, tmp_path) == [("A", "A", "2024-01-01", 2.0), ("A", "A", "2024-01-02", 3.0)]


def test_files_a_few_at_a_time(spark, tmp_path):
    raw = tmp_path / "raw"
    for part in range(5):
        land(raw, "A", part, [f"2024-01-01,{part}.0,A", f"2024-01-0{part + 2},1.0,A"])
    incremental.clean_landed(spark, str(raw), str(tmp_path / "state"), buckets=2, max_files=2)
    assert state(spark, tmp_path) == one_run(spark, tmp_path) and len(state(spark, tmp_path)) == 6


def test_nothing_has_landed(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    incremental.clean_landed(spark, str(tmp_path / "raw"), str(tmp_path / "state"))
    assert incremental.clean_state(spark, str(tmp_path / "state")).count() == 0
    assert incremental.rejected_state(spark, str(tmp_path / "state")).count() == 0
    assert incremental.clean_state(spark, str(tmp_path / "none")).where(F.col("value") > 0).count() == 0
