"""Repeated keys of a table without moving its keys.

Each task reduces its keys to slots, the first bits of a 64-bit hash, and sends
them sorted, as differences of a byte or two. A slot that occurs twice, in one
task or in two, may hold a repeated key; a slot that occurs once cannot. Only the
rows of such slots are then grouped by their keys, which settles them exactly.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.session import scratch_path

# Executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Slots a row: one of so many unequal pairs shares one by chance.
SLOTS_A_ROW = 32
#: Rows whose slots one task sorts or merges.
ROWS_A_RANGE = 4_000_000
#: Doubtful slots that are broadcast at most (8 MB).
BROADCAST_SLOTS = 1_000_000


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """``(key, n)`` of the non-null values of ``column`` that occur more than once."""
    spark = df.sparkSession
    keys = df.select(F.col(column).alias("key")).where(F.col("key").isNotNull())
    rows = keys.count()
    bits = min(62, max(8, math.ceil(math.log2(max(1, rows) * SLOTS_A_ROW))))
    slot = _slot(F.col("key"), bits)
    doubtful = _written(spark, _shared_slots(keys.select(slot.alias("slot")), bits, rows), "shared-slots")
    if doubtful.limit(BROADCAST_SLOTS + 1).count() <= BROADCAST_SLOTS:
        doubtful = F.broadcast(doubtful)
    return (
        keys.join(doubtful, slot == F.col("slot"), "left_semi")
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def _slot(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def _shared_slots(slots: DataFrame, bits: int, rows: int) -> DataFrame:
    """``(slot)`` of the slots that occur more than once."""
    ranges = max(1, -(-rows // ROWS_A_RANGE))
    width = -(-(1 << bits) // ranges)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column("slot").to_numpy())
            n += batch.num_rows
            if n >= ROWS_A_RANGE:
                yield from _packed(np.concatenate(held), width)
                held, n = [], 0
        if held:
            yield from _packed(np.concatenate(held), width)

    def shared(key: tuple, parts: pa.Table) -> pa.Table:
        # Some ROWS_A_RANGE slots at a byte or two.
        places = np.concatenate([_unpacked(part.as_py()) for part in parts.column("part")])
        found, counts = np.unique(places, return_counts=True)
        return pa.table({"slot": pa.array(found[counts > 1] + key[0].as_py() * width, pa.int64())})

    return (
        slots.mapInArrow(pack, "range LONG, part BINARY")
        .groupBy("range")
        .applyInArrow(shared, "slot LONG")
    )


def _packed(slots: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """The slots by range, as compressed differences of their sorted places."""
    slots = np.sort(slots)
    numbers = slots // width
    cuts = np.flatnonzero(np.diff(numbers)) + 1
    for part in np.split(slots, cuts):
        if len(part):
            places = part - part[0] // width * width
            steps = np.diff(places, prepend=0)
            size = np.uint8 if steps.max() < 1 << 8 else np.uint16 if steps.max() < 1 << 16 else np.int64
            # Small steps fill few of a byte's bits, which compression takes out.
            body = np.dtype(size).char.encode() + zlib.compress(steps.astype(size).tobytes(), 1)
            yield pa.record_batch({"range": pa.array([int(part[0] // width)]), "part": pa.array([body], pa.binary())})


def _unpacked(body: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(body[1:]), np.dtype(body[:1].decode()))
    return np.cumsum(steps.astype(np.int64))


def _written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
