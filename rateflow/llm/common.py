"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.session import scratch_path

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Odd, and 3 modulo 8: no two different words of under 256 bytes can then be
# made to collide by their shape alone, whatever their bytes.
_RADIX = 0x9E3779B97F4A7C1B
_LONG_WORD = 256


def saved(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` from a table written to the shared folder.

    Cuts the lineage: what a lost executor held is read again, not worked out
    again, and joins of such tables can be split where a key is hot.
    """
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every end of an edge ``(a, b)``.

    ``component`` is the smallest id reachable. Each round takes the smallest
    label among a node, its neighbours and the node its label names, so paths
    halve from round to round. A round is one written table of two longs per
    node; nothing but two sums reaches the driver.
    """
    both = saved(
        spark,
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(),
        "links",
    )
    labels = saved(
        spark,
        both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("component")),
        "labels",
    )
    total = _label_sum(labels)
    while True:
        near = both.join(labels, both["b"] == labels["id"]).select(
            F.col("a").alias("id"), "component"
        )
        far = labels.select("id", F.col("component").alias("at")).join(
            labels.select(F.col("id").alias("at"), "component"), "at"
        ).select("id", "component")
        labels = saved(
            spark,
            labels.union(near).union(far).groupBy("id").agg(F.min("component").alias("component")),
            "labels",
        )
        after = _label_sum(labels)
        if after == total:
            return labels
        total = after


#: Rows whose Python objects a task holds at a time; Arrow batches may be larger.
SLICE_ROWS = 512


def sliced(
    batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, owner: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, without copying.

    What an earlier operator's tasks kept in this worker is dropped first, unless
    its ``owner`` is this one; what the rows took is given back after the last.
    """
    worker_cache(owner)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None
    release_memory()


def worker_cache(owner: str | None) -> dict:
    """What a Python worker keeps between the tasks of one owner; the caller
    bounds its size. Workers outlive stages, so another owner finds it empty."""
    module = sys.modules.setdefault("_rateflow_worker", types.ModuleType("_rateflow_worker"))
    if not hasattr(module, "kept") or module.owner != owner:
        module.owner, module.kept = owner, {}
        release_memory()
    return module.kept


def release_memory() -> None:
    """Give memory that is free inside this process back to the machine. A worker
    waits for its next task beside others, so what it holds on to adds up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


class Recent(dict):
    """Values made on demand; drops what was not asked for lately."""

    def __init__(self, limit: int, make: Callable) -> None:
        super().__init__()
        self._limit, self._make, self._older = limit, make, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self._limit:
            self._older = dict(self)
            self.clear()


def _label_sum(labels: DataFrame):
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]


#: Ids that are broadcast at most (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def rows_of(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` with (``left_anti``: without) a doc_id in ``ids``.

    Up to ``BROADCAST_IDS`` ids go to the tasks, so that texts are not shuffled.
    """
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", how)


def crc_remainder(doc_id: Column, divisor: int = 3) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int
) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``max_rows`` labelled training rows,
    one an id: where an id has several texts, the one with the smallest MD5.

    Rows held out (crc32 of the id, modulo 3, is 1) and rows without a label
    never enter. The choice is by hash of the id, so it does not depend on how
    the tables are laid out. An id labelled both ways is left out.
    """
    usable = labels.where(
        F.col("doc_id").isNotNull()
        & F.col(label).isin(0, 1)
        & (crc_remainder(F.col("doc_id")) != 1)
    )
    one = (
        usable.groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .where(F.col("label") == F.col("other"))
    )
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("doc_id", "label")
    # At most max_rows rows of two numbers.
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.md5("text")).alias("text")).select(
        "doc_id", "text", "label"
    )


class WordHasher:
    """64-bit hashes of the words of UTF-8 bytes, worked out in whole arrays.

    Words are maximal runs without ASCII white space. A word's hash is a
    polynomial in its bytes; words of 256 bytes or more are hashed one by one.
    """

    def __init__(self) -> None:
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self._powers = _powers(_RADIX, size)
        self._inverses = _powers(pow(_RADIX, -1, 1 << 64), size)

    def spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        word = ~_SPACE[np.frombuffer(data, np.uint8)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
        return edges[::2], edges[1::2]

    def each(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The word hashes of each text; short texts are worked out together."""
        for group in grouped(texts):
            data = b" ".join(group)
            hashes, starts = self._hashes(data)
            firsts = np.cumsum([0, *(len(text) + 1 for text in group)])
            cuts = np.searchsorted(starts, firsts)
            for first, last in zip(cuts[:-1], cuts[1:]):
                yield hashes[first:last]

    def words(self, data: bytes) -> np.ndarray:
        return self._hashes(data)[0]

    def _hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = self.spans(data)
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        if len(data) > len(self._powers):
            self._grow(2 * len(data))
        codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum(codes * self._powers[: len(codes)])]
        )
        hashes = (sums[ends] - sums[starts]) * self._inverses[starts]
        hashes = mixed(hashes + (ends - starts).astype(np.uint64))
        for at in np.flatnonzero(ends - starts >= _LONG_WORD):
            hashes[at] = xxhash.xxh3_64_intdigest(data[starts[at] : ends[at]])
        return hashes, starts


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def grouped(items: Iterable[bytes], size: int = 1 << 17) -> Iterator[list[bytes]]:
    """Consecutive items in lists of about ``size`` bytes (an item stays whole)."""
    held: list[bytes] = []
    total = 0
    for item in items:
        held.append(item)
        total += len(item) + 1
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Slopes and, last, the intercept of a logistic regression (damped Newton)."""
    design = np.column_stack([x, np.ones(len(x))])
    at = np.zeros(design.shape[1])
    penalty = ridge * np.eye(design.shape[1])

    def loss(weights: np.ndarray) -> float:
        margin = design @ weights
        return float(np.logaddexp(0, margin).sum() - y @ margin + weights @ penalty @ weights / 2)

    now = loss(at)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        step = np.linalg.solve(
            (design.T * (p * (1 - p) + 1e-9)) @ design + penalty,
            design.T @ (p - y) + penalty @ at,
        )
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > now:
            size /= 2
        after = loss(at - size * step)
        if size <= 1e-6 or now - after < 1e-9:
            break
        at, now = at - size * step, after
    return at
