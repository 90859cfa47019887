import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rateflow.plans import pipeline
from rateflow.sources import tables, versions


@pytest.fixture
def name(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    versions.create(spark, name, str(tmp_path / name))
    yield name
    for database in [*versions.versions(spark, name), name]:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.fixture
def rates(observations):
    days = [f"2024-01-{d:02d}" for d in range(1, 6)]
    return lambda factor: observations(
        [(s, s, day, factor * (i + 1)) for s in ("DEXBZUS", "DGS2", "DGS10", "FEDFUNDS") for i, day in enumerate(days)]
    )


def spot(spark, name):
    return [r["spot_rate"] for r in tables.read_mart(spark, f"{name}.fx_analytics_mart", ["spot_rate"], ["spot_rate"]).collect()]


def test_a_build_replaces_the_one_before_in_one_step(spark, name, rates):
    with pytest.raises(FileNotFoundError):
        spot(spark, name)
    first = pipeline.replace_all(spark, rates(1.0), name, buckets=2)
    held = versions.read_table(spark, f"{name}.fx_analytics_mart")
    assert versions.current(spark, name) == first == f"{name}__v1"
    second = pipeline.replace_all(spark, rates(10.0), name, buckets=2)
    assert spot(spark, name) == [10.0, 20.0, 30.0, 40.0, 50.0]
    # Who began with the old version can still read it.
    assert sorted(r["spot_rate"] for r in held.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    pipeline.replace_all(spark, rates(2.0), name, buckets=2, keep=1)
    assert versions.versions(spark, name) == [f"{name}__v3"] and second != versions.current(spark, name)


def test_a_build_that_fails_half_way_changes_nothing(spark, name, rates, monkeypatch):
    pipeline.replace_all(spark, rates(1.0), name, buckets=2)
    whole = pipeline.save_table

    def fails(df, table):
        if table.endswith("yield_curve_mart"):
            raise OSError("a lost disk")
        whole(df, table)

    monkeypatch.setattr(pipeline, "save_table", fails)
    with pytest.raises(OSError):
        pipeline.replace_all(spark, rates(7.0), name, buckets=2)
    monkeypatch.undo()
    assert versions.current(spark, name) == f"{name}__v1"
    assert spot(spark, name) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert versions.read_table(spark, f"{name}.yield_curve_mart").count() == 5
    # The next build does not trip over what is left.
    assert pipeline.replace_all(spark, rates(3.0), name, buckets=2) == f"{name}__v3"
    assert spot(spark, name)[0] == 3.0


def test_a_build_whose_tests_fail_is_not_published(spark, name, rates, observations):
    pipeline.replace_all(spark, rates(1.0), name, buckets=2)
    twice = rates(5.0).unionByName(rates(6.0))  # two rows a key
    with pytest.raises(pipeline.DataTestsFailed, match="stg_fx_rates.fx_rate_id unique"):
        pipeline.replace_all(spark, twice, name, buckets=2)
    assert spot(spark, name) == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_names_without_versions_stay_as_they_are(spark, name):
    assert versions.resolved(spark, "plain") == "plain"
    assert versions.resolved(spark, f"{name}.t") == f"{name}.t"
    assert versions.resolved(spark, "nowhere.t") == "nowhere.t"
    with pytest.raises(ValueError):
        versions.publish(spark, name, name, keep=0)


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_saving_one_series_leaves_the_others_files(spark, observations, rows, day, tmp_path):
    path = str(tmp_path / "obs")
    names = ["A", "B c", "D=e/é"]
    tables.save_series(observations([(n, n, "2024-01-01", 1.0) for n in names]), path)
    before = files(path)
    tables.save_series(
        observations([("B c", "B c", "2024-01-03", 3.0), ("B c", "B c", "2024-01-02", 2.0)]), path
    )
    after = files(path)
    same = {p for p in before if "B" not in p}
    assert len(same) == 2 and all(after[p] == before[p] for p in same)
    assert not set(p for p in before if "B" in p) & set(after)
    assert rows(tables.read_observations(spark, path)) == [
        ("A", "A", day("2024-01-01"), 1.0), ("B c", "B c", day("2024-01-02"), 2.0),
        ("B c", "B c", day("2024-01-03"), 3.0), ("D=e/é", "D=e/é", day("2024-01-01"), 1.0),
    ]
    tables.save_series(observations([]), path)
    assert files(path) == after


def test_series_are_not_saved_into_a_flat_directory(spark, observations, tmp_path):
    path = str(tmp_path / "obs")
    tables.write_observations(observations([("A", "A", "2024-01-01", 1.0)]), path)
    with pytest.raises(ValueError, match="as a whole"):
        tables.save_series(observations([("A", "A", "2024-01-02", 1.0)]), path)


def test_row_groups_are_skipped_by_series_and_date(spark, observations, tmp_path):
    path = str(tmp_path / "obs")
    tables.save_series(observations([("A", "A", "2024-01-01", 1.0), ("B", "B", "2024-01-01", 1.0)]), path)
    chosen = tables.read_observations(spark, path).where((F.col("series_file") == "A") & (F.col("date") > "2023-01-01"))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series_file" in plan and "GreaterThan(date,2023-01-01)" in plan
    assert chosen.count() == 1
