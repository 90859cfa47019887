"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Only the number of pieces of each length matters to a packing, and there are at
most ``capacity`` lengths. So the plan is made from that bounded table: bins that
are filled alike are one entry with a count, however many they are. Pieces are
then numbered within their length, in parallel, and look up their place.

The plan: pieces above a third of the capacity go at most two to a bin, matched
greedily (the longest with the longest that fits beside it); the rest, longest
first, go where they leave the smallest gap.
"""

from __future__ import annotations

import bisect
import json
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import Recent, saved, sliced, worker_cache

CAPACITY = 2048
#: Stretches, and words without their punctuation, whose ids a Python worker
#: keeps at most, in two generations each (some 200 bytes an entry). Fewer take
#: less memory and more time, and give the same ids.
CACHED = (150_000, 300_000)
_PUNCTUATION = b".,;:!?)]}%&*#$|\"-"
# The split that keeps letters, single digits and other signs apart.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters below this code point are letters in every version of Unicode.
_STABLE_LETTERS = "\u0500"
_PIECE = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"


class WordTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A tokenizer that lower-cases, drops white space, takes letters and other
    signs apart and never joins across either can work piece by piece: texts are
    cut at ASCII white space, stretches into their letters and the signs after
    them, and what was met lately is kept. Any other encodes whole texts.
    """

    def __init__(self, path: str, cached: tuple[int, int] = CACHED) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._by_word = _works_by_word(self._tokenizer)
        self._stretches = Recent(cached[0], self._stretch)
        self._words = Recent(cached[1], self._word)

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        for text in texts:
            if self._by_word:
                yield b"".join(map(self._stretches.__getitem__, text.split()))
                self._stretches.trim()
                self._words.trim()
            else:
                yield self._whole(text.decode())

    def _stretch(self, stretch: bytes) -> bytes:
        head = stretch.rstrip(_PUNCTUATION)
        if head.decode().isalpha():
            return self._words[head.lower()] + self._words[stretch[len(head) :]]
        return self._words[stretch]

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isalpha() and max(text) < _STABLE_LETTERS:
            if not text.isascii():
                text = self._tokenizer.normalizer.normalize_str(text)
                if not text.isalpha():
                    return self._whole(word.decode())
                text = self._byte_level.pre_tokenize_str(text)[0][0]
            return array("I", [t.id for t in self._tokenizer.model.tokenize(text)]).tobytes()
        return self._whole(text)

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def _works_by_word(tokenizer) -> bool:
    """Whether the tokenizer's parts are those that ``WordTokenizer`` can cut for."""
    parts = json.loads(tokenizer.to_str())
    normal = (parts["normalizer"] or {}).get("normalizers", [])
    before = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    model = parts["model"]
    return (
        sys.byteorder == "little"
        and [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"]
        and normal[1]["pattern"] == {"Regex": "\\s+"}
        and [p["type"] for p in before] == ["Split", "ByteLevel"]
        and before[0]["pattern"] == {"Regex": _WORD_PATTERN}
        and (before[0]["behavior"], before[0]["invert"]) == ("Removed", True)
        and not (before[1]["add_prefix_space"] or before[1]["use_regex"])
        and model["type"] == "BPE"
        and not model["dropout"]
    )


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
    cached: tuple[int, int] = CACHED,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of every document.

    A document is its token ids and ``end_id``; one above ``capacity`` is cut
    into pieces of it, the last one shorter. A null or empty text is ``end_id``
    alone. Each repeated row has pieces of its own. ``cached`` bounds what a worker
    keeps (``CACHED``).
    """
    step = 4 * capacity
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache("packing")
        if (tokenizer_path, cached) not in kept:
            kept.clear()
            kept[tokenizer_path, cached] = WordTokenizer(tokenizer_path, cached)
        tokenizer = kept[tokenizer_path, cached]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in sliced(batches, owner="packing"):
            rows = []
            texts = ((text or "").encode() for text in batch.column("text").to_pylist())
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(), tokenizer.encode(texts)
            ):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = _PIECE + (", ids BINARY" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class _Bins:
    """``count`` bins filled alike: slots ``(length, first number, offset, repeats)``."""

    count: int
    gap: int
    slots: list[tuple[int, int, int, int]]

    def split(self, count: int) -> "_Bins":
        """Take ``count`` bins off the front."""
        taken = _Bins(count, self.gap, list(self.slots))
        self.slots = [(n, first + count * many, at, many) for n, first, at, many in self.slots]
        self.count -= count
        return taken


@dataclass(frozen=True)
class Plan:
    """Places by length and number: arrays sorted by length and first number.

    Number ``i`` of a slot ``(length, first, base, offset, repeats)`` goes to
    sequence ``base + (i - first) // repeats``, behind the earlier repeats.
    """

    slots: np.ndarray
    sequences: int

    def place(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length, first, base, offset, repeats = self.slots.T
        found = np.empty(len(lengths), np.int64)
        for n in np.unique(lengths):
            low, high = np.searchsorted(length, [n, n + 1])
            rows = lengths == n
            found[rows] = low + np.searchsorted(first[low:high], numbers[rows], "right") - 1
        nth = numbers - first[found]
        return (
            base[found] + nth // repeats[found],
            offset[found] + nth % repeats[found] * lengths,
        )


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The packing of ``counts[length]`` pieces, in time bounded by ``capacity``."""
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    bins: list[_Bins] = []

    def take(length: int, count: int) -> int:
        first = used[length]
        used[length] += count
        left[length] -= count
        return first

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            # The longest other that fits; with one of its own length, in pairs.
            at = bisect.bisect_right(large, min(n, capacity - n)) - 1
            while at >= 0 and (left[large[at]] == 0 or (large[at] == n and left[n] < 2)):
                at -= 1
            if at < 0:
                count = left[n]
                bins.append(_Bins(count, capacity - n, [(n, take(n, count), 0, 1)]))
            elif large[at] == n:
                count = left[n] // 2
                bins.append(_Bins(count, capacity - 2 * n, [(n, take(n, 2 * count), 0, 2)]))
            else:
                m = large[at]
                count = min(left[n], left[m])
                slots = [(n, take(n, count), 0, 1), (m, take(m, count), n, 1)]
                bins.append(_Bins(count, capacity - n - m, slots))

    open_bins: dict[int, list[_Bins]] = {}
    gaps: list[int] = []

    def put(group: _Bins) -> None:
        if group.gap not in open_bins:
            open_bins[group.gap] = []
            bisect.insort(gaps, group.gap)
        open_bins[group.gap].append(group)

    for group in bins:
        put(group)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                many = capacity // n
                put(_Bins(-(-left[n] // many), capacity, []))
                continue
            gap = gaps[at]
            group = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap], gaps[at]
            # Best fit fills one bin before it opens the next of its kind.
            many = gap // n
            for repeats, count in ((many, left[n] // many), (left[n] % many, 1)):
                count = min(count, group.count)
                if repeats and count and left[n]:
                    part = group.split(count)
                    first = take(n, repeats * count)
                    part.slots.append((n, first, capacity - gap, repeats))
                    part.gap -= n * repeats
                    put(part)
            if group.count:
                put(group)

    rows, sequences = [], 0
    for group in (g for groups in open_bins.values() for g in groups):
        rows += [(n, first, sequences, at, many) for n, first, at, many in group.slots]
        sequences += group.count
    rows.sort()
    return Plan(np.array(rows, np.int64).reshape(-1, 5), sequences)


def pack(
    spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = 2000
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    Null ids are an id like others, and repeated pieces have a place each; no
    pieces make no sequence. Lengths are never null and at most ``capacity``.

    Pieces of one length are numbered bucket by bucket, so a length that most
    pieces have is no single task's work; the driver sees one count per length.
    """
    pieces = saved(spark, pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_bins(counts, capacity)
    buckets = min(4096, max(1, sum(counts.values()) // rows_per_bucket))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).alias("bucket")
    dealt = pieces.select("*", bucket)
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length",
        "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (
        dealt.withColumn("nth", F.row_number().over(within) - 1)
        .join(before, ["length", "bucket"])
        .select(*pieces.columns, (F.col("before") + F.col("nth")).alias("number"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sequence, offset = plan.place(
                np.asarray(batch.column("length")), np.asarray(batch.column("number"))
            )
            columns = [batch.column(name) for name in batch.schema.names if name != "number"]
            names = [name for name in batch.schema.names if name != "number"]
            yield pa.record_batch(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)`` of pieces packed with their ``ids``.

    A group is one sequence: at most ``capacity`` ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "").alias("hex"),
    ).select("sequence_id", "length", F.unhex("hex").alias("ids"))
