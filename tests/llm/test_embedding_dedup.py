from __future__ import annotations

import math
import random

import numpy as np
import pytest

from rateflow.llm import embedding_dedup as dedup
from rateflow.llm.oracle import ORACLE_SQL
from rateflow.llm.queries import REGISTRY

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def brute(rows, similarity=0.98):
    """(n_links, component) by row number, over all pairs."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def usable(row):
        vec_id, vector, label = row
        return (
            vec_id is not None and label is not None and vector
            and all(v is not None and math.isfinite(v) for v in vector) and any(vector)
        )

    links = [0] * len(rows)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if j < i and usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.float32(r[1]).astype(np.float64) for r in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= similarity:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    lowest = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            root = find(i)
            lowest[root] = min(lowest.get(root, row[0]), row[0])
    return sorted(
        (str(row[0]), links[i], str(lowest.get(find(i))), row[0] is None or lowest[find(i)] == row[0])
        for i, row in enumerate(rows)
    )


def found(df):
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in df.collect())


def clustered(n, width, seed):
    random.seed(seed)
    centres = [[random.gauss(0, 1) for _ in range(width)] for _ in range(n // 8)]
    return [
        (i, [x + random.gauss(0, 0.1) for x in random.choice(centres)], random.choice([0, 1, 1, None]))
        for i in range(n)
    ]


def test_query_matches_sql(spark, duck, same_rows, sf_dir):
    name = "op1_embedding_near_dedup"
    same_rows(REGISTRY[name](spark, sf_dir), duck.sql(ORACLE_SQL[name]))


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_no_link_is_lost_whatever_the_blocks(spark, monkeypatch, block_rows):
    monkeypatch.setattr(dedup, "CELL_ROWS", 4)
    rows = clustered(400, 9, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(dedup.near_duplicates(spark, df, block_rows=block_rows)) == brute(rows)


def test_odd_vectors_copies_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (9, [1.0, 0.0], 1), (4, [1.0, 0.0], 2),
        (6, [0.0, 0.0], 1), (7, None, 1), (8, [], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1),
        (12, [None, 1.0], 1), (13, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (14, [1.0], 1),
        (15, [1.0, 0.0, 0.0], 1), (16, [-0.0, 1.0], 3), (17, [0.0, 1.0], 3),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rep", "'k' AS key", "2 AS n_links")
    assert found(dedup.near_duplicates(spark, df)) == brute(rows)


def test_empty_table(spark):
    assert dedup.near_duplicates(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_multi_sequence_visits_cells_in_order():
    random.seed(1)
    left, right = (np.array([random.random() for _ in range(n)]) for n in (5, 7))
    visited = dedup.multi_sequence(left, right, 0.9)
    sums = [left[c // 7] + right[c % 7] for c in visited]
    assert sums == sorted(sums) and len(visited) == len(set(visited))
    assert len(visited) == int((left[:, None] + right[None, :] <= 0.9).sum())


def test_lower_target_recall_is_reached(spark):
    rows = clustered(600, 12, 8)
    units = dedup.unit_vectors(np.array([r[1] for r in rows]))
    index = dedup.train(units, 2000 * 4, 0.98, target_recall=0.95)
    cells = index.cells(units)
    a, b = np.nonzero(np.triu(units @ units.T >= 0.98, 1))
    visits = [set(v) for v in index.visits(units)]
    assert np.mean([cells[j] in visits[i] for i, j in zip(a, b)]) >= 0.9
