from __future__ import annotations

import math

import numpy as np
import pytest

from rateflow.llm import whitening
from rateflow.llm.queries import REGISTRY, table

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>"


def plain(rows, components=4):
    """By whole arrays and a library's eigenvalues."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * c) for c in v] for _, v in usable], object)
    distinct = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, sums = len(distinct), distinct.sum(axis=0)
    mean = np.array([s / n for s in sums], float)
    y = distinct.astype(float) - mean
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = ((n * x - sums) ** 2).sum(axis=1).tolist()
    whitened = (x.astype(float) - mean) @ vectors / np.sqrt(values)
    return usable, n, deviations, whitened, values / np.trace(covariance)


def check(got, rows, digits=9):
    usable, n, deviations, whitened, explained = plain(rows)
    k = len(explained)
    assert len(got) == k * len(usable)
    by_id = {(r["vec_id"], r["component"]): r for r in got}
    signs = np.ones(k)
    for at, (i, _) in enumerate(usable):
        for m in range(k):
            row = by_id[i, m + 1]
            assert (row["n"], row["deviation"]) == (n, deviations[at])
            if at == 0:
                signs[m] = 1 if row["whitened"] * whitened[0, m] >= 0 else -1
            assert row["whitened"] == pytest.approx(signs[m] * whitened[at, m], rel=1e-6, abs=10**-digits)
            assert row["explained"] == pytest.approx(explained[m], rel=1e-9)
            assert 0 <= row["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


def test_query_equals_plain_arrays(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    check(REGISTRY["op13_embedding_whitening"](spark, sf_dir).collect(), rows)


def test_flawed_and_repeated_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.standard_normal(6) * [5, 4, 3, 2, 1, 0.5]).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(500)]  # copies count once in the fit
    flawed = [(900, None), (901, []), (902, [1.0, None, 0, 0, 0, 0]), (903, [math.nan] + [0.0] * 5), (904, [math.inf] + [0.0] * 5), (905, [1e300] + [0.0] * 5), (906, [1.0, 2.0])]
    vectors = spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v], "x") for i, v in rows + flawed],
        SCHEMA + ", n STRING",
    )
    check(whitening.whiten(spark, vectors).collect(), rows)


def test_rows_without_id_come_out(spark):
    vectors = spark.createDataFrame([(None, [0.0, 1.0]), (None, [0.0, 1.0]), (1, [1.0, 3.0])], SCHEMA)
    got = whitening.whiten(spark, vectors).collect()
    assert [(r["vec_id"], r["component"], r["n"]) for r in sorted(got, key=str)] == [(1, 1, 2), (None, 1, 2), (None, 1, 2)]
    assert all(abs(r["whitened"]) == pytest.approx(1) for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.001, 2.0])], [(1, None)]])
def test_nothing_to_span(spark, rows):
    got = whitening.whiten(spark, spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_deviations_beyond_a_long_are_null(spark):
    vectors = spark.createDataFrame([(1, [1e13, 0.0]), (2, [-1e13, 1.0]), (3, [0.0, 0.0])], SCHEMA)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark, vectors).collect()}
    assert got[1] is None and got[2] is None and got[3] == 256**2


def test_many_partitions_add_up(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(400)]
    grid = whitening.grid_vectors(spark.createDataFrame(rows, SCHEMA)).select("x")
    width = 5
    n, sums = whitening._sums(grid, width)
    x = np.array([r["x"] for r in grid.collect()])
    assert (n, sums) == (400, x.sum(axis=0).tolist())
    mean = np.array([s / n for s in sums])
    product = whitening._mean_product(grid.repartition(150), n, mean, np.eye(width))
    np.testing.assert_allclose(product, (x - mean).T @ (x - mean) / n, rtol=1e-12)


@pytest.mark.parametrize("seed", range(60))
def test_components_equal_a_library(seed):
    rng = np.random.default_rng(seed)
    d, n = int(rng.integers(1, 30)), int(rng.integers(2, 150))
    x = rng.integers(-128, 128, (n, d)).astype(float)
    if seed % 3 == 0:
        x *= np.exp(-5 * rng.random(d))
    if seed % 4 == 0:
        x[:, : d // 2] = x[:, :1]  # spans less
    if seed % 5 == 0:
        x = np.vstack([np.eye(d), -np.eye(d)]) * 8  # all eigenvalues equal
    y = x - x.mean(axis=0)
    covariance = y.T @ y / len(x)
    all_values = np.linalg.eigvalsh(covariance)[::-1]
    for shift in rng.random(5) * all_values[0]:
        assert whitening.below(covariance, shift) == (all_values < shift).sum()
    values, axes = whitening.leading_components(covariance, 4)
    scale = np.trace(covariance)
    np.testing.assert_allclose(values, all_values[: len(values)], rtol=1e-9)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max(initial=0) < 1e-10
    assert np.abs(covariance @ axes - axes * values).max(initial=0) < 1e-11 * scale
    assert len(values) == min(4, (all_values > 1e-12 * scale).sum())
