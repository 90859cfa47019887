"""Periodic runs of words: stretches in which a passage repeats itself back to back.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends. Its first two words of a period, ``s`` and ``s + q``,
start suffixes that agree on exactly ``length - q`` words, and no position
between them starts one that agrees so far with both. So runs are found by
uniting classes of suffixes by falling length of their longest common prefix
(Kruskal over the suffix array's LCP values): each class is an ordered set of
positions, and where a union makes two positions neighbours whose distance the
common prefix covers, they seed a run.

Texts are worked on in whole arrays, many short ones or one long one at a time;
a document never leaves its task and nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rateflow.llm.common import sliced

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Bytes of text that are worked on together; a longer text is worked on alone.
GROUP_BYTES = 1 << 20

Prepare = Callable[[int | None, bytes], bytes]
Runs = list[tuple[int, int, int]]

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = (
    "doc_id LONG, n_words LONG,"
    " runs ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>, collapsed STRING"
)


def find_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    prepare: Prepare | None = None,
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every document.

    ``runs`` holds ``(start, length, period)`` in words, by start and period, of
    every run of at least ``min_length`` words and ``min_exponent`` (2 or more)
    periods. ``collapsed`` is the text without the words that any run holds
    after its first period, one space between words. ``prepare`` may rewrite a
    text (UTF-8 bytes, with its id) beforehand.

    Words are maximal stretches without ASCII white space, compared byte by
    byte. A null or empty text has no words, no runs and an empty collapsed
    text; a null id is kept; each repeated row has a result of its own. Columns
    other than ``doc_id`` and ``text`` are not looked at.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = (text.as_py() or b"" for text in batch.column("text"))
            if prepare is not None:
                texts = (prepare(doc_id, text) for doc_id, text in zip(ids, texts))
            done = 0
            for group in _grouped(texts):
                n_words, runs, collapsed = _group_runs(group, min_length, min_exponent)
                yield pa.record_batch(
                    [
                        pa.array(ids[done : done + len(group)], pa.int64()),
                        pa.array(n_words, pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], pa.list_(_RUN)),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                done += len(group)

    return docs.select("doc_id", docs["text"].cast("binary").alias("text")).mapInArrow(run, _SCHEMA)


def least_common_prefix(min_length: int, min_exponent: int) -> int:
    """The fewest words that the two seeds of a wanted run have in common."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, max(min_length, 1) + 1))


def _grouped(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    held: list[bytes] = []
    total = 0
    for text in texts:
        if held and total + len(text) > GROUP_BYTES:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text) + 1
    if held:
        yield held


def _group_runs(
    texts: list[bytes], min_length: int, min_exponent: int
) -> tuple[list[int], list[Runs], list[bytes]]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8).copy()
    starts, ends, words = _words(data)
    # Document d has the words cuts[d] to cuts[d + 1].
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(text) + 1 for text in texts)]))
    counts = np.diff(cuts)
    doc = np.repeat(np.arange(len(texts)), counts)
    found = _runs(words, doc, cuts, min_length, min_exponent)

    change = np.zeros(len(words) + 1, np.int64)
    runs: list[Runs] = [[] for _ in texts]
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
        d = doc[start]
        runs[d].append((int(start - cuts[d]), int(length), int(period)))
    for each in runs:
        each.sort(key=lambda r: (r[0], r[2]))
    kept = np.cumsum(change[:-1]) == 0

    # Each kept word with the byte behind it, which becomes its space.
    data[ends] = 0x20
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[kept]] = 1
    edges[ends[kept] + 1] -= 1
    joined = data[np.cumsum(edges[:-1], dtype=np.int8).view(bool)].tobytes()
    sizes = np.concatenate([[0], np.cumsum(np.where(kept, ends - starts + 1, 0))])[cuts]
    collapsed = [joined[a : max(a, b - 1)] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist())]
    return counts.tolist(), runs, collapsed


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and numbers of the words; equal words have equal numbers."""
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = pa.py_buffer(np.ascontiguousarray(data[inside]))
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), letters]
    )
    return starts, ends, words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _runs(
    words: np.ndarray, doc: np.ndarray, cuts: np.ndarray, min_length: int, min_exponent: int
) -> Runs:
    if not len(words):
        return []
    least = least_common_prefix(min_length, min_exponent)
    earlier, later, common = _common_prefixes(words, doc, cuts, least)
    # Largest first.
    order = np.argsort(-common, kind="stable")
    return _united(
        words,
        cuts[doc],
        zip(earlier[order].tolist(), later[order].tolist(), common[order].tolist()),
        min_length,
        min_exponent,
    )


def _common_prefixes(
    words: np.ndarray, doc: np.ndarray, cuts: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(i, j, lcp)`` of the suffixes next to each other in the suffix array of
    their document, where they have at least ``least`` words in common."""
    suffixes, agreed = _suffix_array(words, doc, cuts[doc + 1])
    slots = np.flatnonzero(2 * agreed > least)
    slots = slots[np.argsort(suffixes[slots])]
    later, earlier, low = suffixes[slots], suffixes[slots - 1], agreed[slots]
    if not len(slots):
        return later, earlier, low
    # Where the words before both are equal, the prefix is one shorter than
    # that of the position before; all others are compared.
    begin = cuts[doc[later]]
    follows = (later > begin) & (earlier > begin)
    follows[follows] = words[later[follows] - 1] == words[earlier[follows] - 1]
    heads = np.flatnonzero(~follows)
    end = cuts[doc[later] + 1]
    common = np.zeros(len(slots), np.int64)
    for at in heads.tolist():
        i, j = int(earlier[at]), int(later[at])
        common[at] = _agreement(words, i, j, int(low[at]), int(end[at]) - max(i, j))
    head = np.maximum.accumulate(np.where(follows, 0, np.arange(len(slots))))
    common = common[head] - (later - later[head])
    wanted = common >= least
    return earlier[wanted], later[wanted], common[wanted]


def _agreement(words: np.ndarray, i: int, j: int, known: int, limit: int) -> int:
    """How many words from ``i`` and ``j`` on are equal: ``known`` or more."""
    step = 64
    while known < limit:
        upto = min(known + step, limit)
        differ = np.flatnonzero(words[i + known : i + upto] != words[j + known : j + upto])
        if len(differ):
            return known + int(differ[0])
        known, step = upto, 2 * step
    return limit


def _suffix_array(
    words: np.ndarray, doc: np.ndarray, stop: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes by document and words, and how far each surely agrees with the
    one before it: ``h``, where the common prefix has ``h`` to ``2 h - 1`` words.

    Prefix doubling that sorts again only what is not told apart yet; texts
    without long repeats are done after the first rounds.
    """
    n = len(words)
    key = doc * (int(words.max()) + 1) + words
    suffixes = np.argsort(key)
    key = key[suffixes]
    first = np.ones(n, bool)
    first[1:] = key[1:] != key[:-1]
    agreed = np.zeros(n, np.int64)
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.maximum.accumulate(np.where(first, slots, 0))
    h = 1
    while True:
        alone = first & np.concatenate([first[1:], [True]])
        slots, first = slots[~alone], first[~alone]
        if not len(slots):
            return suffixes, agreed
        at = suffixes[slots]
        ahead = at + h
        inside = ahead < stop[at]
        second = np.zeros(len(at), np.int64)
        second[inside] = rank[ahead[inside]] + 1
        key = rank[at] * (n + 1) + second
        order = np.argsort(key)
        key, at = key[order], at[order]
        suffixes[slots] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        agreed[slots[fresh & ~first]] = h
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        first = fresh
        h *= 2


def _united(
    words: np.ndarray,
    begin: np.ndarray,
    edges: Iterable[tuple[int, int, int]],
    min_length: int,
    min_exponent: int,
) -> Runs:
    """The runs seeded by uniting suffix classes along ``(i, j, lcp)``, largest
    common prefix first."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    runs: Runs = []
    seeds: list[tuple[int, int]] = []
    level = -1

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def seed(x: int, y: int) -> None:
        # The prefix covers the distance, and the run starts at x.
        distance = y - x
        if (
            distance * (min_exponent - 1) <= level
            and distance + level >= min_length
            and (x == begin[x] or words[x - 1] != words[y - 1])
        ):
            seeds.append((x, y))

    def finish() -> None:
        # Classes of one level are united one by one: a seed holds if its ends
        # are still neighbours when all are.
        for x, y in seeds:
            positions = members[find(x)]
            if positions[bisect_left(positions, x) + 1] == y:
                runs.append((x, y - x + level, y - x))
        seeds.clear()

    for i, j, common in edges:
        if common != level:
            finish()
            level = common
        for x in (i, j):
            if x not in parent:
                parent[x] = x
                members[x] = [x]
        a, b = find(i), find(j)
        large, small = members[a], members[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        del members[b]
        if small[0] > large[-1]:
            seed(large[-1], small[0])
            large += small
            continue
        if small[-1] < large[0]:
            seed(small[-1], large[0])
            large[:0] = small
            continue
        for at, x in enumerate(small):
            place = bisect_left(large, x)
            if place and (at == 0 or small[at - 1] < large[place - 1]):
                seed(large[place - 1], x)
            if place < len(large) and (at + 1 == len(small) or small[at + 1] > large[place]):
                seed(x, large[place])
        if 16 * len(small) > len(large):
            large += small
            large.sort()
        else:
            for x in small:
                insort(large, x)
    finish()
    return runs
