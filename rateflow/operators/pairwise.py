"""Correlations of all series of one frame with all of another, by day.

Pairwise-complete: a pair counts the days on which both have a value. With values
and masks as matrices of days by series, the counts, sums, squares and products
of all pairs of two blocks of series are six matrix products, and they add up
over stretches of days. So one pass in blocks gives every pair, where an
aggregate a pair would read each series once for each of the others.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.coercion import nan_to_null

# Executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SERIES_A_BLOCK, DAYS_A_CHUNK = 128, 4096
#: A variance below this share of the squares is rounding: no spread.
NO_SPREAD = 1e-13

_PART = "l INT, r INT, left_ids ARRAY<STRING>, right_ids ARRAY<STRING>, moments BINARY"
_PAIRS = "left_id STRING, right_id STRING, observations LONG, correlation DOUBLE"


def pairwise_correlations(
    left: DataFrame,
    right: DataFrame,
    series_a_block: int = SERIES_A_BLOCK,
    days_a_chunk: int = DAYS_A_CHUNK,
) -> DataFrame:
    """``(left_id, right_id, observations, correlation)`` of every pair of series
    of ``left`` and ``right (series_id, date, value)`` with a day in common.

    One value a day and series. Rows with a NULL or NaN count for nothing. The
    correlation is NULL without spread on either side, under two days, or where
    an infinity takes part. A task holds two blocks of series over one chunk of
    days; each reading is sent once for every opposing block.
    """
    blocks = [_blocks(side, series_a_block) for side in (left, right)]
    parts = _dealt(left, *blocks, days_a_chunk, own=0).groupBy("l", "r", "chunk").cogroup(
        _dealt(right, *blocks, days_a_chunk, own=1).groupBy("l", "r", "chunk")
    )
    return (
        parts.applyInArrow(_moments, _PART)
        .groupBy("l", "r")
        .applyInArrow(_correlations, _PAIRS)
    )


def _blocks(side: DataFrame, series_a_block: int) -> int:
    n = side.agg(F.approx_count_distinct("series_id")).first()[0]
    return max(1, math.ceil(n / series_a_block))


def _dealt(side: DataFrame, left_blocks: int, right_blocks: int, days: int, own: int) -> DataFrame:
    """The side's rows for each opposing block. Values are taken less their
    series' mean, which changes no correlation and keeps squares small."""
    sound = side.select("series_id", "date", "value").where(
        F.col("series_id").isNotNull() & F.col("date").isNotNull() & nan_to_null(F.col("value")).isNotNull()
    )
    finite = F.when(F.abs("value") < float("inf"), F.col("value"))
    means = sound.groupBy("series_id").agg(F.avg(finite).alias("mean"))
    day = F.unix_date("date")
    counts, names = (left_blocks, right_blocks), ("l", "r")
    mine = F.pmod(F.xxhash64("series_id"), F.lit(counts[own])).cast("int").alias(names[own])
    each = F.explode(F.sequence(F.lit(0), F.lit(counts[1 - own] - 1))).alias(names[1 - own])
    return sound.join(means, "series_id").select(
        mine,
        each,
        F.floor(day / days).cast("int").alias("chunk"),
        "series_id",
        day.alias("day"),
        (F.col("value") - F.coalesce("mean", F.lit(0.0))).alias("value"),
    )


def _moments(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The sums of all pairs of two blocks over one chunk of days: the six of a
    correlation, and how many infinities take part."""
    l, r, _ = (k.as_py() for k in key)
    days = np.unique(np.concatenate([left["day"].to_numpy(), right["day"].to_numpy()]))
    ids, sides = [], []
    for table in (left, right):
        names, columns = np.unique(table["series_id"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        x, mask, wild = np.zeros((3, len(days), len(names)))
        at = np.searchsorted(days, table["day"].to_numpy())
        value = table["value"].to_numpy()
        x[at, columns] = np.where(np.isfinite(value), value, 0.0)
        mask[at, columns] = 1.0
        wild[at, columns] = ~np.isfinite(value)
        ids.append(names.tolist())
        sides.append((x, mask, wild))
    (x, mx, wx), (y, my, wy) = sides
    sums = np.stack([
        mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y, wx.T @ my + mx.T @ wy,
    ])
    return pa.table(
        {
            "l": pa.array([l], pa.int32()),
            "r": pa.array([r], pa.int32()),
            "left_ids": pa.array([ids[0]], pa.list_(pa.string())),
            "right_ids": pa.array([ids[1]], pa.list_(pa.string())),
            "moments": pa.array([sums.tobytes()], pa.binary()),
        }
    )


def _correlations(parts: pa.Table) -> pa.Table:
    """Every pair of two blocks, from the sums of all chunks."""
    left, right = (sorted({i for ids in parts[c].to_pylist() for i in ids}) for c in ("left_ids", "right_ids"))
    rows, columns = ({name: at for at, name in enumerate(names)} for names in (left, right))
    total = np.zeros((7, len(left), len(right)))
    for at in range(parts.num_rows):
        a, b, part = (parts[c][at].as_py() for c in ("left_ids", "right_ids", "moments"))
        part = np.frombuffer(part).reshape(7, len(a), len(b))
        total[:, np.array([rows[i] for i in a], int)[:, None], np.array([columns[i] for i in b], int)] += part
    n, x, y, xx, yy, xy, wild = total
    with np.errstate(all="ignore"):
        spread_x, spread_y = xx - x * x / n, yy - y * y / n
        r = np.clip((xy - x * y / n) / np.sqrt(spread_x * spread_y), -1, 1)
        sound = (n >= 2) & (wild == 0) & (spread_x > NO_SPREAD * xx) & (spread_y > NO_SPREAD * yy) & np.isfinite(r)
    i, j = np.nonzero(n)
    return pa.table(
        {
            "left_id": pa.array([left[k] for k in i], pa.string()),
            "right_id": pa.array([right[k] for k in j], pa.string()),
            "observations": pa.array(n[i, j].astype(np.int64)),
            "correlation": pa.array(r[i, j], pa.float64(), mask=~sound[i, j]),
        }
    )
