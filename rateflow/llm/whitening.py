"""Whitening of embeddings by their leading principal components.

The spectrum of the covariance is sliced: factoring ``V - s I`` into ``L D L'``
and counting the negative pivots tells how many eigenvalues lie below ``s``
(Sylvester's law of inertia), so bisection isolates the m-th largest one.
Rayleigh quotient iteration then converges to it cubically, and two more counts
around the value found certify its number.

The data are only ever summed: distinct vectors by a shuffle, their sums and
centred products in tasks. What reaches the driver is a matrix as large as the
dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import saved

#: An entry ``c`` becomes ``floor(STEPS * c)``; beyond this it has no long.
STEPS, ENTRY_LIMIT = 256, float(2**55)
#: Partial sums that one task adds up.
FAN_IN = 64
_PIVOT = (1 + 17**0.5) / 8
_LONG_MAX = 2**63 - 1

_WHITENED = "vec_id LONG, n LONG, deviation LONG, whitened ARRAY<DOUBLE>"


@dataclass(frozen=True)
class Model:
    """``n`` distinct vectors with integer ``sums``; unit ``vectors`` (columns)
    with their ``values``, largest first; ``trace`` of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whiten(
    spark: SparkSession, embeddings: DataFrame, components: int = 4
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Rows whose vector is null or empty, or holds a null, an infinite or NaN entry,
    or one whose ``floor(256 c)`` is no long, are left out. So are those of
    another length than most have (of equally frequent lengths, the longest
    counts), as there is no covariance across lengths. Repeated rows all come
    out, as do null ids; each distinct vector is fitted once. ``deviation`` is
    null where it does not fit a long. Components whose eigenvalue is zero to
    double precision do not come out: fewer than ``components`` where the
    vectors span less, none for a single vector or an empty table.
    """
    grid = grid_vectors(embeddings)
    model = fit(spark, grid, components)
    schema = (
        "vec_id LONG, component INT, n LONG, deviation LONG, whitened DOUBLE,"
        " explained DOUBLE, identity_error DOUBLE"
    )
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    explained = F.array(*[F.lit(float(value / model.trace)) for value in model.values])
    return (
        transform(grid, model)
        .select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            "n",
            "deviation",
            "whitened",
            explained[F.col("at")].alias("explained"),
            F.lit(model.identity_error).alias("identity_error"),
        )
    )


def grid_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the sound rows: entries as longs."""
    entry = F.col("embedding").cast("array<double>")
    sound = F.forall(entry, lambda c: F.coalesce(F.abs(c) < ENTRY_LIMIT, F.lit(False)))
    return embeddings.where((F.size("embedding") > 0) & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(entry, lambda c: F.floor(c * STEPS).cast("long")).alias("x"),
    )


def fit(spark: SparkSession, grid: DataFrame, components: int = 4) -> Model | None:
    """The components of the distinct vectors of ``grid``; None without rows."""
    vectors = saved(spark, grid.select("x").distinct(), "distinct-vectors")
    lengths = grid.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if common is None:
        return None
    vectors = vectors.where(F.size("x") == common["length"])
    n, sums = _sums(vectors, common["length"])
    mean = np.array([s / n for s in sums])
    covariance = _mean_product(vectors, n, mean, np.eye(common["length"]))
    values, axes = leading_components(covariance, components)
    scaled = axes / np.sqrt(values)
    error = 0.0
    if len(values):
        whitened = _mean_product(vectors, n, mean, scaled)
        error = float(np.abs(whitened - np.eye(len(values))).max())
    return Model(n, sums, values, axes, float(np.trace(covariance)), error)


def transform(grid: DataFrame, model: Model) -> DataFrame:
    """``(vec_id, n, deviation, whitened)`` of the rows of the fitted length."""
    n, sums, mean = model.n, model.sums, model.mean
    scaled = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), len(sums))
            whitened = (x - mean) @ scaled
            offsets = np.arange(0, whitened.size + 1, max(1, whitened.shape[1]), dtype=np.int32)
            yield pa.record_batch(
                [
                    batch.column("vec_id"),
                    pa.array([n] * len(x), pa.int64()),
                    pa.array(_deviations(x, n, sums), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(whitened.ravel())),
                ],
                names=["vec_id", "n", "deviation", "whitened"],
            )

    return grid.where(F.size("x") == len(sums)).mapInArrow(run, _WHITENED)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of ``(n x - S)²`` of each row, exactly."""
    largest = n * max(1, int(np.abs(x.astype(object)).max(initial=0))) + max(map(abs, sums))
    if largest**2 * len(sums) <= _LONG_MAX:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(d) if d <= _LONG_MAX else None for d in exact]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and each dimension's exact sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            n += len(x)
            if np.abs(x.astype(np.float64)).max(initial=0) * max(1, len(x)) < 2.0**62:
                sums = [a + b for a, b in zip(sums, x.sum(axis=0).tolist())]
            else:
                sums = [a + int(b) for a, b in zip(sums, x.astype(object).sum(axis=0))]
        yield pa.record_batch(
            [
                pa.array(range(-1, width), pa.int32()),
                pa.array([n, *sums], pa.decimal128(38, 0)),
            ],
            names=["at", "total"],
        )

    parts = vectors.mapInArrow(run, "at INT, total DECIMAL(38,0)")
    totals = {r["at"]: int(r["total"]) for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect()}
    return totals[-1], [totals[at] for at in range(width)]


def _mean_product(vectors: DataFrame, n: int, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The covariance, with divisor ``n``, of the vectors seen along ``axes``:
    centred by ``mean``, then multiplied."""
    k = axes.shape[1]
    plain = axes.shape[0] == k and np.array_equal(axes, np.eye(k))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            y = _matrix(batch.column("x"), len(mean)) - mean
            if not plain:
                y = y @ axes
            yield y.T @ y

    def add(matrices: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, k))
            for matrix in matrices(batches):
                total += matrix
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["part"])

        return run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for part in batch.column("part"):
                yield np.frombuffer(part.as_py(), np.float64).reshape(k, k)

    parts = vectors.mapInArrow(add(products), "part BINARY")
    left = vectors.rdd.getNumPartitions()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = parts.repartition(left).mapInArrow(add(read), "part BINARY")
    # At most FAN_IN matrices of the dimension's size.
    total = sum(np.frombuffer(r["part"], np.float64).reshape(k, k) for r in parts.collect())
    return total / n


def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are below ``shift``: the
    negative ones of D in ``L D L'``, with pivots of one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    count = 0
    while len(a):
        if len(a) == 1:
            return count + int(a[0, 0] < 0)
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1
        largest = column[r - 1]
        width = 1
        if abs(a[0, 0]) < _PIVOT * largest:
            row = np.abs(a[r])
            row[r] = 0
            other = row.max()
            if abs(a[0, 0]) * other < _PIVOT * largest**2:
                if abs(a[r, r]) >= _PIVOT * other:
                    _swap(a, 0, r)
                else:
                    _swap(a, 1, r)
                    width = 2
        if width == 1:
            if a[0, 0] != 0:
                count += int(a[0, 0] < 0)
                side = a[1:, 0]
                a = a[1:, 1:] - np.outer(side, side / a[0, 0])
            else:  # the rest of the column is zero too
                a = a[1:, 1:].copy()
        else:
            count += int((np.linalg.eigvalsh(a[:2, :2]) < 0).sum())
            side = a[2:, :2]
            a = a[2:, 2:] - side @ np.linalg.solve(a[:2, :2], side.T)
    return count


def _swap(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


def leading_components(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns.

    A vector's entry of largest size is positive. Values that are zero to double
    precision are left out. Equal ones get orthogonal vectors.
    """
    size = len(covariance)
    trace = float(np.trace(covariance))
    tiny = 4 * size * np.finfo(float).eps * trace
    values: list[float] = []
    axes = np.zeros((size, 0))
    for m in range(1, min(components, size) + 1):
        if trace <= 0 or size - below(covariance, tiny) < m:
            break
        value, axis = _component(covariance, m, axes, trace, tiny)
        # Certified: m values from here up, fewer than m from just above.
        if below(covariance, value - tiny) > size - m or below(covariance, value + tiny) < size - m + 1:
            raise ArithmeticError(f"eigenvalue {m} is not the one found at {value}")
        values.append(value)
        axes = np.column_stack([axes, axis * np.sign(axis[np.abs(axis).argmax()])])
    return np.array(values), axes


def _component(
    covariance: np.ndarray, m: int, found: np.ndarray, trace: float, tiny: float
) -> tuple[float, np.ndarray]:
    """The m-th largest eigenvalue and a unit vector of it, by slicing until it
    is alone (or as good as equal to its neighbours) and then iterating."""
    size = len(covariance)
    low, high = 0.0, trace + tiny
    # size - below(s) values are s or more: m or more at low, fewer at high.
    n_low, n_high = size, 0
    start = np.random.default_rng(m).standard_normal(size)
    while True:
        while high - low > tiny and (n_low > m or n_high < m - 1):
            middle = (low + high) / 2
            n = size - below(covariance, middle)
            low, n_low, high, n_high = (middle, n, high, n_high) if n >= m else (low, n_low, middle, n)
        equal = high - low <= tiny
        axis, value = start, (low + high) / 2
        for step in range(30):
            axis = _solved(covariance, value, axis, tiny, found)
            # Two plain steps first, towards the nearest to the middle.
            quotient = float(axis @ covariance @ axis)
            residual = float(np.linalg.norm(covariance @ axis - quotient * axis))
            if equal:
                if residual <= tiny:
                    return quotient, axis
                continue
            if step >= 2:
                if not low <= quotient <= high:
                    break
                value = quotient
            if residual <= tiny / 4 and low <= quotient <= high:
                return quotient, axis
        if equal:
            raise ArithmeticError(f"no eigenvector found for eigenvalue {m}")
        # Went astray, or stands still: a narrower slice.
        middle = (low + high) / 2
        n = size - below(covariance, middle)
        low, n_low, high, n_high = (middle, n, high, n_high) if n >= m else (low, n_low, middle, n)


def _solved(
    covariance: np.ndarray, shift: float, axis: np.ndarray, tiny: float, found: np.ndarray
) -> np.ndarray:
    """One step of inverse iteration, kept apart from the vectors found before."""
    eye = np.eye(len(covariance))
    try:
        axis = np.linalg.solve(covariance - shift * eye, axis)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        axis = np.linalg.solve(covariance - (shift + tiny) * eye, axis)
    axis = axis / np.linalg.norm(axis)
    for _ in range(2):
        axis = axis - found @ (found.T @ axis)
        axis = axis / np.linalg.norm(axis)
    return axis
