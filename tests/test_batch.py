import io
import zipfile

import pytest

from rateflow.plans.batch import landed_observations, run_from_payloads, run_from_raw_csv


@pytest.fixture
def landing(tmp_path):
    for name in ("json", "sdmx", "other", "archives"):
        (tmp_path / name).mkdir()
    days = [f'{{"date": "2024-01-0{d}", "value": "{5 + d / 10}"}}' for d in range(1, 6)]
    (tmp_path / "json" / "DEXBZUS.json").write_text('{"observations": [' + ", ".join(days) + "]}")
    (tmp_path / "json" / "FEDFUNDS.json").write_text('{"observations": [{"date": "2024-01-01", "value": "5.25"}]}')
    (tmp_path / "json" / "DGS10.json").write_text('{"error_message": "no"}')
    (tmp_path / "sdmx" / "ECB_DEPOSIT_RATE.csv").write_text("KEY,TIME_PERIOD,OBS_VALUE\nk,2024-01-01,4.0\nk,2024-01-02,4.0\n")
    (tmp_path / "sdmx" / "EURIBOR_3M.csv").write_text("KEY,TIME_PERIOD,OBS_VALUE\nk,soon,4.0\n")
    (tmp_path / "other" / "x.csv").write_text("error\nnone\n")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("d.csv", "FREQ,Series,2023,2023-Q1\nA,X:1,1.0,2.0\n")
    (tmp_path / "archives" / "BIS_OTC_DERIV.zip").write_bytes(buffer.getvalue())
    return tmp_path


def _sources(landing):
    return {
        "json_path": str(landing / "json"),
        "sdmx_paths": [str(landing / "sdmx"), str(landing / "other")],
        "archive_path": str(landing / "archives"),
    }


def test_unsound_payloads_do_not_stop_the_rest(spark, landing, rows):
    observations, rejected = landed_observations(spark, **_sources(landing))
    assert sorted({r.series_id for r in observations.collect()}) == ["DEXBZUS", "ECB_DEPOSIT_RATE", "FEDFUNDS", "X:1"]
    assert rows(rejected) == [
        ("DGS10", "no_observations"), ("EURIBOR_3M", "bad_date"), ("x", "missing_column:TIME_PERIOD"),
    ]
    with pytest.raises(ValueError, match="no source"):
        landed_observations(spark)


def test_missing_paths_are_listed_and_the_rest_goes_on(spark, landing, rows):
    sources = _sources(landing)
    sources["sdmx_paths"].append(str(landing / "gone"))
    for name in ("json_path", "archive_path"):
        observations, rejected = landed_observations(spark, **{**sources, name: str(landing / name)})
        assert {(str(landing / name), "missing"), (str(landing / "gone"), "missing")} <= set(rows(rejected))
        assert observations.count() == (2 + 1 * 2 if name == "json_path" else 2 + 6)
    observations, rejected = landed_observations(spark, json_path=str(landing / "gone"))
    assert observations.count() == 0 and rows(rejected) == [(str(landing / "gone"), "missing")]


def test_payloads_to_marts(spark, landing, rows, day):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS payloads LOCATION '{landing}/db'")
    run_from_payloads(spark, str(landing / "work"), "payloads", buckets=2, **_sources(landing))
    assert rows(spark.table("payloads.rate_differential_mart")) == [
        (day("2024-01-01"), 5.25, 4.0, 1.25), (day("2024-01-02"), None, 4.0, None),
    ]
    assert rows(spark.table("payloads.fact_derivatives")) == [(20230101, "BIS_OTC_DERIV", "X:1", 2.0)]
    assert spark.table("payloads.fx_analytics_mart").count() == 5
    assert spark.read.parquet(f"{landing}/work/rejected").count() == 3


def test_raw_csv_to_marts(spark, tmp_path, rows):
    (tmp_path / "raw").mkdir()
    for name, body in {
        "DGS10": "2024-01-02,4.0,DGS10\n2024-01-01,3.0,DGS10\n2024-01-01,3.5,DGS10\n",
        "DGS2": "2024-01-01,4.5,DGS2\n",
        "DGS1MO": "",
        "FEDFUNDS": "never,1.0,FEDFUNDS\n",
        "BIS_FX_TURNOVER": "2023-01-01,1.0,A:1\n2023-01-01,2.0,B:2\n",
    }.items():
        (tmp_path / "raw" / f"{name}.csv").write_text("date,value,series_id\n" + body)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS rawcsv LOCATION '{tmp_path}/db'")
    run_from_raw_csv(spark, str(tmp_path / "raw"), str(tmp_path / "work"), "rawcsv", buckets=2)
    curve = spark.table("rawcsv.yield_curve_mart")
    assert [(r.yield_2y, r.yield_10y, r.is_inverted) for r in curve.orderBy("rate_date").collect()] == [
        (4.5, 3.5, True), (None, 4.0, None),
    ]
    assert [r.series_id for r in spark.table("rawcsv.dim_series").orderBy("series_id").collect()] == ["DGS10", "DGS1MO", "DGS2"]
    assert spark.table("rawcsv.fact_derivatives").count() == 2
    assert rows(spark.read.parquet(f"{tmp_path}/work/rejected")) == [("FEDFUNDS", "bad_date")]
