from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from rateflow.llm import minhash
from rateflow.llm.common import WordHasher, connected_components
from rateflow.llm.queries import REGISTRY, table


def brute(rows, width, percent=80):
    """(doc_id, n_shingles, component, kept) by all pairs that share a shingle."""
    sets = {i: minhash.shingles_of(minhash.words_of(t), width) for i, t in rows}
    lists = collections.defaultdict(list)
    for i, found in sets.items():
        for shingle in found:
            lists[shingle].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        common = collections.Counter(j for s in sets[i] for j in lists[s] if j > i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("width", [2, 5])
def test_table_matches_brute_force(spark, sf_dir, width):
    docs = table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(minhash.near_duplicates(spark, docs, width)) == brute(rows, width)
    if width == 2:
        assert found(REGISTRY["op7_minhash_near_dedup"](spark, sf_dir)) == brute(rows, 2)


def test_chains_groups_and_common_shingles(spark, documents):
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, words = [], random.choices(vocabulary, k=300)
    for i in range(60):  # a chain: each differs a little from the one before
        for _ in range(4):
            words[random.randrange(300)] = random.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    for i in range(60):  # short texts of few words, alike by chance
        rows.append((2000 + i, " ".join(random.choices(["a", "b", "c"], k=random.randint(0, 9)))))
    line = " ".join(random.choices(vocabulary, k=40))
    for i in range(40):  # a common passage in different texts
        rows.append((3000 + i, line + " " + " ".join(random.choices(vocabulary, k=random.randint(1, 400)))))
    assert found(minhash.near_duplicates(spark, documents(rows), 2)) == brute(rows, 2)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A"), (5, "a"), (6, "A  b"), (7, "a b"),
            (8, "x " * 60_000), (9, "X\n" * 59_000)]
    docs = documents([*rows, (None, "a"), (4, "A")]).selectExpr("*", "'d' AS digest", "1 AS n_shingles")
    made = collections.Counter(tuple(r) for r in minhash.near_duplicates(spark, docs, 2).collect())
    expected = collections.Counter(brute(rows, 2))
    expected[(4, 1, 4, True)] += 1
    expected[(None, 1, None, True)] += 1
    assert made == expected
    assert minhash.near_duplicates(spark, documents([]), 2).count() == 0


def test_keep_one(spark, documents):
    docs = documents([(5, "a b c"), (3, "A b c"), (3, "A b c"), (9, "other"), (None, "a b c"), (7, None)])
    kept = minhash.keep_one(spark, docs.selectExpr("*", "true AS kept"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "7", "9", "None"]
    assert kept.columns[-1] == "kept"


def test_least_overlap_allows_for_chance():
    random.seed(3)
    least = minhash.least_overlap(64, 80)
    universe = np.arange(400)
    for _ in range(300):
        values = np.random.default_rng(_).permutation(1 << 20)[:400]
        shared, a, b = values[:320], values[320:360], values[360:]
        assert len(shared) / len(universe) == 0.8
        x = np.sort(np.concatenate([shared, a]))[:64]
        y = np.sort(np.concatenate([shared, b]))[:64]
        assert len(np.intersect1d(x, y)) >= least


def test_word_hashes_tell_words_apart():
    hasher = WordHasher()
    texts = [b"", b"a", b"a a", b"  ab\tc\nab ", b"x" * 300 + b" y", "é ü".encode()]
    for text, hashes in zip(texts, hasher.each(texts)):
        words = text.split()
        assert len(hashes) == len(words) and len(set(words)) == len(set(hashes.tolist()))
    one, other = hasher.words(b"ab c ab").tolist(), list(hasher.each([b"zz", b"ab c ab"]))[1].tolist()
    assert one == other and one[0] == one[2]


def test_connected_components(spark):
    edges = [(9, 4), (4, 2), (2, 7), (30, 31), *((i, i + 1) for i in range(100, 160))]
    labels = connected_components(spark, spark.createDataFrame(edges, "a LONG, b LONG"))
    by = {r["id"]: r["component"] for r in labels.collect()}
    assert {by[i] for i in (9, 4, 2, 7)} == {2} and by[31] == 30
    assert {by[i] for i in range(100, 161)} == {100}


@pytest.mark.parametrize("size", [8, 64])
def test_lists_of_a_block_estimate_as_the_union_sketch_does(size):
    rng = np.random.default_rng(11)
    base = [np.unique(rng.integers(0, 150, n, dtype=np.uint64)) for n in rng.integers(1, 140, 60)]
    probes = [np.unique(rng.integers(0, 150, n, dtype=np.uint64)) for n in rng.integers(1, 140, 20)]
    lists = minhash.SketchLists([s[:size] for s in base], size, 80)
    least = minhash.least_overlap(size, 80)
    for probe in [*probes, *base[:5]]:
        a, expected = probe[:size], []
        for j, other in enumerate(base):
            b = other[:size]
            both = np.union1d(a, b)
            overlap = len(np.intersect1d(both[:size], np.intersect1d(a, b)))
            whole = len(both) <= size
            if j % 7 and overlap > 0 and overlap >= (len(both) * 0.8 - 1e-6 if whole else least):
                expected.append(j)
        assert lists.likely(a, np.arange(len(base)) % 7 > 0).tolist() == expected
    assert minhash.SketchLists([], size, 80).likely(base[0][:size], np.zeros(0, bool)).tolist() == []


def test_cluster_of_many_blocks(spark, documents, monkeypatch):
    """Several components in one cluster: near each other, but not over 0.8."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    random.seed(21)
    words = [f"w{i}" for i in range(400)]
    rows, doc_id = [], 0
    for _ in range(6):
        own = words[:]
        for at in random.sample(range(400), 45):
            own[at] = f"v{random.randrange(10 ** 6)}"
        for _ in range(30):
            doc_id += 1
            copy = own[:]
            for at in random.sample(range(400), random.choice([2, 10, 18])):
                copy[at] = f"u{random.randrange(10 ** 6)}"
            rows.append((doc_id, " ".join(copy)))
    random.shuffle(rows)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    expected = brute(rows, 2)
    assert 6 <= len({component for _, _, component, _ in expected}) < 100
    assert found(minhash.near_duplicates(spark, documents(rows), 2)) == expected
