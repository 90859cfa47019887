from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rateflow.llm import packing
from rateflow.llm.queries import REGISTRY, table, tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


def bins_of(lengths, capacity):
    """Each bin's ``(offset, length)`` under the plan."""
    counts = collections.Counter(lengths)
    plan = packing.plan_bins(counts, capacity)
    n = np.array([n for n, c in counts.items() for _ in range(c)], np.int64)
    i = np.array([i for _, c in counts.items() for i in range(c)], np.int64)
    made = collections.defaultdict(list)
    for sequence, offset, length in zip(*plan.place(n, i), n):
        made[int(sequence)].append((int(offset), int(length)))
    return [sorted(b) for b in made.values()]


def best_fit(lengths, capacity):
    """Bins of a plain best-fit decreasing, piece by piece."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_gapless_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([9, 20, 64, 300])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 400))]
    made = bins_of(lengths, capacity)
    assert sum(len(b) for b in made) == len(lengths)
    for pieces in made:
        ends = np.cumsum([n for _, n in pieces])
        assert [o for o, _ in pieces] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert sum(3 * n > capacity for _, n in pieces) <= 2
    assert len(made) <= 1.05 * best_fit(lengths, capacity) + 1


def expected_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    found = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            found.append((str(doc_id), piece, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(found)


def check_packed(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_matches_the_tokenizer(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    packed = REGISTRY["op9_best_fit_packing"](spark, sf_dir).collect()
    assert sorted((str(r[0]), *r[1:5]) for r in packed) == expected_pieces(rows, 2048)
    used = check_packed(packed, 2048)
    assert used <= 1.02 * -(-sum(r["length"] for r in packed) // 2048) + 1


ODD = [
    (1, None), (2, ""), (3, "<|endoftext|> a<|startoftext|>b it's I'LL"), (4, "ΑΣ ΣΑΣ İstanbul ﬁ"),
    (5, "é é ́x a b\x85c d\x1ce 12ab x² Ⅷ ª"), (None, "the"), (6, "the"), (6, "the"),
    (7, "word. " * 30_000), (8, "x" * 5000), (9, "日本 ǅ ß K"),
]


def test_odd_texts(spark, documents):
    docs = documents(ODD).selectExpr("*", "1 AS piece", "2 AS length", "3 AS number")
    packed = packing.pack(spark, packing.token_pieces(docs, PATH, 64), 64, rows_per_bucket=50).collect()
    assert sorted((str(r[0]), *r[1:5]) for r in packed) == expected_pieces(ODD, 64)
    check_packed(packed, 64)
    assert packing.pack(spark, packing.token_pieces(documents([]), PATH)).count() == 0


def test_other_tokenizers_encode_whole_texts(spark, documents):
    path = tokenizer_file("byte_bpe_50k.json")
    ids = np.frombuffer(next(packing.WordTokenizer(path).encode([b"a  b\n"])), "<u4").tolist()
    assert ids == Tokenizer.from_file(path).encode("a  b\n", add_special_tokens=False).ids


def test_sequences_hold_the_ids(spark, documents):
    pieces = packing.token_pieces(documents(ODD[:6]), PATH, 32, with_ids=True)
    packed = packing.pack(spark, pieces, 32)
    held = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = held[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


def test_recent_keeps_its_bound_and_its_values():
    kept = packing.Recent(10, lambda key: key * 2)
    for i in range(100):
        assert kept[i % 37] == i % 37 * 2
        kept.trim()
        assert len(kept) <= 11
