"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its units: paragraphs (lines), cut at sentence ends, so
that an edit inside a long paragraph leaves its other sentences alone. Each unit
is hashed to a wide vector, and a text's fingerprint is the sum of its units'
vectors, lane by lane modulo powers of two. So it does not depend on the order of
units, and adding or removing units is adding or subtracting their fingerprint.

The vector has two parts. Wide lanes (modulo 2^64) decide equality. Narrow lanes
(modulo 2^32) hold +1 or -1; sums of these keep the inner product of two
multisets on average, which estimates how alike two texts are; no text has so many
units that they wrap.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import saved, sliced

WIDE, NARROW = 4, 128
_UNITS = re.compile(r"[\r\n]+|(?<=[.!?])[ \t]+")


def units(text: str) -> list[str]:
    return [unit for unit in _UNITS.split(text) if unit and not unit.isspace()]


class Fingerprint:
    """Sums of the units' vectors; ``+`` and ``-`` insert and delete."""

    __slots__ = ("wide", "narrow")

    def __init__(self, wide: np.ndarray, narrow: np.ndarray) -> None:
        self.wide, self.narrow = wide, narrow

    @classmethod
    def of(cls, parts: Iterable[str]) -> Fingerprint:
        digests = b"".join(
            hashlib.blake2b(part.encode(), digest_size=8 * WIDE + NARROW // 8).digest()
            for part in parts
        )
        rows = np.frombuffer(digests, np.uint8).reshape(-1, 8 * WIDE + NARROW // 8)
        wide = np.ascontiguousarray(rows[:, : 8 * WIDE]).view("<u8").sum(axis=0, dtype=np.uint64)
        ones = np.unpackbits(rows[:, 8 * WIDE :], axis=1).sum(axis=0, dtype=np.int64)
        return cls(wide, (2 * ones - len(rows)).astype(np.uint64).astype("<u4"))

    @classmethod
    def of_text(cls, text: str) -> Fingerprint:
        return cls.of(units(text))

    @classmethod
    def from_hex(cls, written: str) -> Fingerprint:
        data = bytes.fromhex(written)
        return cls(
            np.frombuffer(data[: 8 * WIDE], "<u8").copy(),
            np.frombuffer(data[8 * WIDE :], "<u4").copy(),
        )

    def hex(self) -> str:
        return (self.wide.astype("<u8").tobytes() + self.narrow.astype("<u4").tobytes()).hex()

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.narrow + other.narrow)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.narrow - other.narrow)

    def __eq__(self, other: object) -> bool:
        return (
            isinstance(other, Fingerprint)
            and bool((self.wide == other.wide).all())
            and bool((self.narrow == other.narrow).all())
        )

    __hash__ = None

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal multisets, else the estimated cosine between them, below 1.

        Two texts without units are alike; one without units is like no other.
        """
        if self == other:
            return 1.0
        a = self.narrow.view(np.int32).astype(np.float64)
        b = other.narrow.view(np.int32).astype(np.float64)
        norm = math.sqrt(float(a @ a) * float(b @ b))
        return min(max(float(a @ b) / norm, 0.0), 1.0 - 1e-6) if norm else 0.0


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_units, fingerprint)`` of every row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            parts = [units(text or "") for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_units": pa.array([len(p) for p in parts], pa.int64()),
                    "fingerprint": pa.array([Fingerprint.of(p).hex() for p in parts], pa.string()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id LONG, n_units LONG, fingerprint STRING"
    )


_ROW = (
    "part INT, at STRING, doc_id LONG, n_chars LONG, edited_sha256 BINARY,"
    " fingerprint BINARY, edited_fingerprint BINARY, near_edited DOUBLE, near_next DOUBLE, text STRING"
)


def edited_neighbours(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document.

    Next is by descending doc_id (null ids last; rows of one id by the text's MD5), the first one
    after the last. The edited text has the last ``n_chars // 2`` code points
    replaced by as many of the next text's first, or all it has. A null text is
    empty; repeated rows each have a place in the order; a single document is its
    own next. Other columns than ``doc_id`` and ``text`` are not read.

    Texts are shuffled once, into ranges of the order; tasks go through a range
    row by row. What spans two ranges is only the last row of one and the first
    of the next: these wait in the written result and are joined in a second
    step, two rows for each range.
    """
    ranged = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.md5("text"))
        .repartitionByRange(F.desc_nulls_last("doc_id"), F.col("tie"))
        .sortWithinPartitions(F.desc_nulls_last("doc_id"), F.col("tie"))
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    compare = _compare

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = part = None
        for batch in sliced(batches):
            out = []
            for part, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = (doc_id, text, Fingerprint.of_text(text))
                if held is None:
                    out.append((part, "first", doc_id, *[None] * 6, text))
                else:
                    out.append((part, "done", *compare(held, own), None))
                held = own
            yield _batch(out)
        if held is not None:
            yield _batch([(part, "last", held[0], *[None] * 6, held[1])])

    walked = saved(spark, ranged.mapInArrow(walk, _ROW), "walked")
    # Two rows for each range: the last of one meets the first of the next.
    order = Window.orderBy("part")
    first = walked.where("at = 'first'").select("part", "doc_id", "text")
    last = walked.where("at = 'last'").select("part", "doc_id", "text")
    ids = first.select("part")
    following = ids.select(
        "part",
        F.coalesce(
            F.lead("part").over(order),
            F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("next"),
    )
    ends = (
        last.join(following, "part")
        .join(first.toDF("next", "next_id", "next_text"), "next")
        .select("doc_id", "text", "next_id", "next_text")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for doc_id, text, next_id, next_text in zip(*(c.to_pylist() for c in batch.columns)):
                pair = [(i, t, Fingerprint.of_text(t)) for i, t in ((doc_id, text), (next_id, next_text))]
                out.append((0, "done", *compare(*pair), None))
            yield _batch(out)

    return (
        walked.where("at = 'done'")
        .union(ends.mapInArrow(finish, _ROW))
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
            F.lower(F.hex("fingerprint")).alias("fingerprint"),
            F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
            "near_edited",
            "near_next",
        )
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(own: tuple, following: tuple) -> tuple:
    doc_id, text, print_ = own
    changed = edited(text, following[1])
    changed_print = Fingerprint.of_text(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).digest(),
        bytes.fromhex(print_.hex()),
        bytes.fromhex(changed_print.hex()),
        print_.likeness(changed_print),
        print_.likeness(following[2]),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [
        ("part", pa.int32()),
        ("at", pa.string()),
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.binary()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("text", pa.string()),
    ]
    return pa.record_batch(
        [pa.array([row[i] for row in rows], t) for i, (_, t) in enumerate(types)],
        names=[name for name, _ in types],
    )
