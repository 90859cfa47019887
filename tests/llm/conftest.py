from __future__ import annotations

import math
import os

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not present")
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in NAMES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(row):
    return tuple(round(v, 9) if isinstance(v, float) and math.isfinite(v) else v for v in row)


@pytest.fixture(scope="session")
def same_rows():
    """Spark rows against DuckDB rows, columns by name, rows in any order."""

    def check(df, relation):
        names = sorted(df.columns)
        assert names == sorted(relation.columns)
        ours = [plain(row) for row in df.select(names).collect()]
        theirs = [plain(row) for row in relation.select(", ".join(f'"{n}"' for n in names)).fetchall()]
        key = lambda row: tuple((v is None, str(v)) for v in row)
        assert sorted(ours, key=key) == sorted(theirs, key=key)

    return check


@pytest.fixture
def documents(spark):
    """Documents ``(doc_id, text)`` with the other columns of the table."""

    def build(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or "")) for i, t in rows],
            "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG",
        )

    return build
