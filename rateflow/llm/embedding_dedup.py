"""Near-duplicate embeddings by an inverted multi-index.

Vectors are scaled to length 1 and cut in halves. Each half has a codebook of its
own, and the pairs of codewords form a grid of cells; a vector lies in the cell
of its nearest codewords. A probe visits cells in order of a lower bound of the
distance to anything inside (the multi-sequence order), and stops at the radius
that the similarity sets, so at full target recall no link can be missed; then
the cosines are computed in double precision. Links never cross labels.

Equal vectors are one class, compared once. Large cells are dealt in blocks, and
a pair of blocks gives counts and a spanning forest of its links, not the links:
rows out grow with rows in, however many links a group has.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import connected_components, saved, sliced

#: Bound of the vectors which the codebooks are trained on.
TRAINING_ROWS = 20000
#: Vectors of a cell that are compared in one task, against as many others.
BLOCK_ROWS = 1024
#: Cells are meant to hold so many vectors of a label; codewords are bounded.
CELL_ROWS, MOST_CODEWORDS = 128, 128


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the two halves, by row; ``target`` is the squared radius visited."""

    left: np.ndarray
    right: np.ndarray
    target: float

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return vectors[:, :cut], vectors[:, cut:]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        left, right = self.halves(vectors)
        return _squares(left, self.left).argmin(1) * len(self.right) + _squares(
            right, self.right
        ).argmin(1)

    def bounds(self, half: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Squared distance from each vector to each codeword's region, at least.

        The regions are bounded by the planes half-way between codewords, so the
        distance to a region is no less than that to the plane before it.
        """
        squares = _squares(half, book)
        own = squares.argmin(1)
        between = np.sqrt(np.maximum(_squares(book, book), 1e-300))
        gap = squares - squares[np.arange(len(half)), own][:, None]
        bound = np.maximum(gap, 0.0) / (2 * between[own])
        bound[np.arange(len(half)), own] = 0.0
        # A little less, for rounding.
        return np.maximum(bound * (1 - 1e-9) - 1e-9, 0.0) ** 2

    def visits(self, vectors: np.ndarray) -> Iterator[list[int]]:
        """The cells that each vector must visit, nearest first."""
        left, right = self.halves(vectors)
        for a, b in zip(self.bounds(left, self.left), self.bounds(right, self.right)):
            yield multi_sequence(a, b, self.target)


def multi_sequence(left: np.ndarray, right: np.ndarray, limit: float) -> list[int]:
    """Grid cells in ascending order of ``left[i] + right[j]``, up to ``limit``."""
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    found, queue, seen = [], [(float(left[rows[0]] + right[columns[0]]), 0, 0)], {(0, 0)}
    while queue:
        bound, i, j = heapq.heappop(queue)
        if bound > limit:
            break
        found.append(int(rows[i]) * len(right) + int(columns[j]))
        for at in ((i + 1, j), (i, j + 1)):
            if at[0] < len(left) and at[1] < len(right) and at not in seen:
                seen.add(at)
                heapq.heappush(queue, (float(left[rows[at[0]]] + right[columns[at[1]]]), *at))
    return found


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    return np.maximum(squares, 0.0)


def train(sample: np.ndarray, n_rows: int, similarity: float, target_recall: float = 1.0) -> MultiIndex:
    """Codebooks by k-means on a sample of unit vectors.

    At full target recall the radius is that of the similarity. Below it, cells
    are visited up to the distance within which that share of the linked pairs of
    the sample lies (all of it where the sample has no such pair).
    """
    cut = sample.shape[1] // 2
    size = round(math.sqrt(n_rows / CELL_ROWS))
    size = max(1, min(size, MOST_CODEWORDS, len(sample)))
    index = MultiIndex(
        _kmeans(sample[:, :cut], size), _kmeans(sample[:, cut:], size), 2 - 2 * similarity + 1e-9
    )
    if target_recall >= 1:
        return index
    some = sample[:2000]
    a, b = np.nonzero(np.triu(_squares(some, some) <= index.target, 1))
    if not len(a):
        return index
    (left, right), cells = index.halves(some), index.cells(some)
    bound = index.bounds(left, index.left)[a, cells[b] // len(index.right)]
    bound += index.bounds(right, index.right)[a, cells[b] % len(index.right)]
    return MultiIndex(index.left, index.right, float(np.quantile(bound, target_recall)) + 1e-12)


def _kmeans(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    random = np.random.default_rng(5)
    centres = points[random.choice(len(points), size, replace=False)].copy()
    for _ in range(rounds):
        nearest = _squares(points, centres).argmin(1)
        for k in range(size):
            own = points[nearest == k]
            if len(own):
                centres[k] = own.mean(0)
    return np.unique(centres, axis=0)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in doubles; rows must be finite and not zero."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def keyed_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, key, vector)`` of each row; no key where it cannot link.

    ``vector`` is the doubles in bytes, and ``key`` names label and vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            vectors, keys = [], []
            for vec_id, label, values in zip(*(c.to_pylist() for c in batch.columns)):
                usable = vec_id is not None and label is not None and values and None not in values
                # Adding zero makes -0.0 and 0.0 the same bytes.
                vector = np.asarray(values, "<f8") + 0.0 if usable else np.zeros(0)
                if not (vector.any() and np.isfinite(vector).all()):
                    vectors.append(None)
                    keys.append(None)
                    continue
                vectors.append(vector.tobytes())
                name = f"{label}:".encode() + vectors[-1]
                keys.append(hashlib.blake2b(name, digest_size=16).hexdigest())
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "key": pa.array(keys, pa.string()),
                    "vector": pa.array(vectors, pa.binary()),
                }
            )

    rows = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    return rows.mapInArrow(run, "vec_id LONG, label LONG, key STRING, vector BINARY")


def near_duplicates(
    spark: SparkSession,
    embeddings: DataFrame,
    similarity: float = 0.98,
    target_recall: float = 1.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of the table.

    Rows link where their labels are equal and not null, their vectors have one
    length, and the cosine is at least ``similarity`` (above 0). Vectors that are
    null, empty, zero or hold nulls or non-finite numbers link with nothing, nor
    do rows without vec_id; such a row without vec_id has no component and is
    kept. Rows that repeat a vec_id each link like any other row; classes of equal
    vectors that have the same smallest vec_id are one member of a component.
    Other columns are not read.
    """
    keyed = saved(spark, keyed_vectors(embeddings), "vectors")
    classes = keyed.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("label").alias("label"),
        F.min("vec_id").alias("rep"),
        F.count(F.lit(1)).alias("many"),
        F.first("vector").alias("vector"),
    )
    classes = saved(spark, classes.withColumn("width", (F.length("vector") / 8).cast("int")), "classes")
    indexes = {}
    sizes = classes.groupBy("width").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("label").alias("labels")
    )
    for width in sizes.collect():  # one row for each vector length
        chosen = classes.where(F.col("width") == width["width"]).orderBy("key").limit(TRAINING_ROWS)
        sample = np.array([np.frombuffer(r["vector"], "<f8") for r in chosen.collect()])
        indexes[width["width"]] = train(
            unit_vectors(sample), width["n"] // max(1, width["labels"]), similarity, target_recall
        )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            vectors = batch.column("vector").to_pylist()
            widths = np.array([len(v) // 8 for v in vectors], np.int32)
            cells = np.zeros(len(vectors), np.int32)
            visits: list[list[int]] = [[]] * len(vectors)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                units = unit_vectors(
                    np.frombuffer(b"".join(vectors[i] for i in at), "<f8").reshape(len(at), -1)
                )
                cells[at] = indexes[int(width)].cells(units)
                # Each pair is met from the side of the later cell.
                for i, found in zip(at, indexes[int(width)].visits(units)):
                    visits[i] = [cell for cell in found if cell <= cells[i]]
            yield pa.record_batch(
                {
                    **{n: batch.column(n) for n in ("key", "label", "rep", "many", "vector")},
                    "width": pa.array(widths),
                    "cell": pa.array(cells),
                    "visits": pa.array(visits, pa.list_(pa.int32())),
                }
            )

    members = saved(
        spark,
        classes.select("key", "label", "rep", "many", "vector").mapInArrow(
            place,
            "key STRING, label LONG, rep LONG, many LONG, vector BINARY,"
            " width INT, cell INT, visits ARRAY<INT>",
        ),
        "members",
    )
    cell = ["label", "width", "cell"]
    probes = members.select(
        "key", "label", "width", F.col("cell").alias("home"), "rep", "many", "vector",
        F.explode("visits").alias("cell"),
    )
    blocks = (
        members.groupBy(cell)
        .agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("bases"))
        .join(
            probes.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("probes")),
            cell,
        )
    )
    blocks = saved(spark, blocks, "blocks")

    def dealt(side: DataFrame, probe: bool) -> DataFrame:
        own, other = ("probes", "bases") if probe else ("bases", "probes")
        mine = F.pmod(F.xxhash64("key"), F.col(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return side.join(blocks, cell).select(
            *cell,
            (mine if probe else each).alias("p"),
            (each if probe else mine).alias("b"),
            F.lit(probe).alias("is_probe"),
            F.col("home") if probe else F.col("cell").alias("home"),
            "key", "rep", "many", "vector",
        )

    def compare(table: pa.Table) -> pa.Table:
        is_probe = np.asarray(table.column("is_probe"))
        home = np.asarray(table.column("home"))
        keys = np.array(table.column("key").to_pylist(), object)
        reps, many = np.asarray(table.column("rep")), np.asarray(table.column("many"))
        joined = b"".join(table.column("vector").to_pylist())
        units = unit_vectors(np.frombuffer(joined, "<f8").reshape(len(keys), -1))
        p, b = np.flatnonzero(is_probe), np.flatnonzero(~is_probe)
        linked = units[p] @ units[b].T >= similarity
        linked &= keys[p][:, None] != keys[b][None, :]
        # Inside a cell each pair is met from both sides, otherwise from one.
        inside = home[p] == (home[b][0] if len(b) else -1)
        counts = {}
        for i in np.flatnonzero(linked.any(1)):
            counts[p[i]] = counts.get(p[i], 0) + int(many[b][linked[i]].sum())
        across = linked[~inside]
        for j in np.flatnonzero(across.any(0)):
            counts[b[j]] = counts.get(b[j], 0) + int(many[p[~inside]][across[:, j]].sum())
        lowest_p, lowest_b = reps[p].copy(), reps[b].copy()
        while True:
            far = np.iinfo(np.int64).max
            next_b = np.minimum(lowest_b, np.where(linked, lowest_p[:, None], far).min(0, initial=far))
            next_p = np.minimum(lowest_p, np.where(linked, next_b[None, :], far).min(1, initial=far))
            if (next_b == lowest_b).all() and (next_p == lowest_p).all():
                break
            lowest_b, lowest_p = next_b, next_p
        lowest = np.empty(len(keys), np.int64)
        lowest[p], lowest[b] = lowest_p, lowest_b
        # Every vector names the lowest one that the block's links lead to.
        at = np.array(sorted({*counts, *np.flatnonzero(lowest < reps)}), np.int64)
        return pa.table(
            {
                "key": pa.array(keys[at], pa.string()),
                "rep": pa.array(reps[at], pa.int64()),
                "n_links": pa.array([counts.get(i, 0) for i in at], pa.int64()),
                "lowest": pa.array(lowest[at], pa.int64()),
            }
        )

    links = saved(
        spark,
        dealt(probes, True)
        .union(dealt(members, False))
        .groupBy(*cell, "p", "b")
        .applyInArrow(compare, "key STRING, rep LONG, n_links LONG, lowest LONG"),
        "links",
    )
    edges = links.where("lowest < rep").select(F.col("lowest").alias("a"), F.col("rep").alias("b"))
    components = connected_components(spark, edges)
    named = saved(
        spark,
        classes.select("key", "rep", "many")
        .join(links.groupBy("key").agg(F.sum("n_links").alias("others")), "key", "left")
        .join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "key",
            # Copies of the vector are links as well.
            (F.coalesce("others", F.lit(0)) + F.col("many") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
        .where("n_links > 0"),
        "named",
    )
    own = F.coalesce("component", "vec_id")
    return (
        keyed.select("vec_id", "key")
        .join(named, "key", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            own.alias("component_id"),
            F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
        )
    )
