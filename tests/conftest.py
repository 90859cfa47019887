from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rateflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day():
    return dt.date.fromisoformat


@pytest.fixture
def raw(spark):
    """Raw rows ``(series_file, date, value, series_id)`` in arrival order."""

    def build(rows):
        return spark.createDataFrame(
            [(*row, i) for i, row in enumerate(rows)],
            "series_file STRING, date STRING, value STRING, series_id STRING, position BIGINT",
        )

    return build


@pytest.fixture
def observations(spark, day):
    """Clean rows ``(series_file, series_id, iso date, value)``."""

    def build(rows):
        return spark.createDataFrame(
            [(file, series, day(date), value) for file, series, date, value in rows],
            "series_file STRING, series_id STRING, date DATE, value DOUBLE",
        )

    return build


def rows(df, *order):
    """Collected rows as tuples, sorted by the given columns or all of them."""
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(name="rows", scope="session")
def rows_fixture():
    return rows
