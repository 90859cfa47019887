import math
import random
import statistics

import pytest

from rateflow.operators.pairwise import pairwise_correlations

INF = float("inf")


def plain(left, right):
    found = {}
    for a in sorted({s for s, *_ in left if s}):
        for b in sorted({s for s, *_ in right if s}):
            x = {d: v for s, d, v in left if s == a and v is not None and v == v}
            y = {d: v for s, d, v in right if s == b and v is not None and v == v}
            days = sorted(x.keys() & y.keys())
            xs, ys = [x[d] for d in days], [y[d] for d in days]
            if not days:
                continue
            r = None
            if len(days) > 1 and len(set(xs)) > 1 and len(set(ys)) > 1 and all(map(math.isfinite, xs + ys)):
                r = statistics.correlation(xs, ys)
            found[a, b] = (len(days), r)
    return found


@pytest.fixture
def frame(spark, day):
    def build(rows):
        return spark.createDataFrame(
            [(s, day(f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}"), v) for s, d, v in rows],
            "series_id STRING, date DATE, value DOUBLE",
        )

    return build


@pytest.mark.parametrize("block, chunk", [(128, 4096), (2, 20)])
def test_every_pair_equals_a_plain_correlation(frame, block, chunk):
    rng = random.Random(5)
    left = [(f"L{s}", d, rng.gauss(100 * s, 3)) for s in range(5) for d in range(200) if rng.random() < 0.6]
    right = [(f"R{s}", d, rng.gauss(0, 1) + d / 50) for s in range(7) for d in range(30 * s, 200) if rng.random() < 0.7]
    left += [("FLAT", d, 7.0) for d in range(200)] + [("ONE", 150, 1.0), ("GONE", 199, None), ("NAN", 3, float("nan"))]
    left += [("FLAT_HERE", d, 5.0 if d >= 180 else float(d)) for d in range(200)] + [("INF", d, INF if d == 4 else float(d)) for d in range(200)]
    right += [("LATE", d, float(d % 3)) for d in range(180, 200)] + [(None, 5, 1.0)]
    got = {
        (r["left_id"], r["right_id"]): (r["observations"], r["correlation"])
        for r in pairwise_correlations(frame(left), frame(right), block, chunk).collect()
    }
    expected = plain(left, right)
    assert got.keys() == expected.keys()
    for pair, (n, r) in expected.items():
        assert got[pair][0] == n
        assert got[pair][1] == (None if r is None else pytest.approx(r, abs=1e-9)), pair


def test_nothing_in_common(frame):
    assert pairwise_correlations(frame([]), frame([("A", 1, 1.0)])).count() == 0
    assert pairwise_correlations(frame([("B", 2, 1.0)]), frame([("A", 1, 1.0)])).count() == 0
