from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from rateflow.llm import periodic_runs
from rateflow.llm.queries import REGISTRY, looped_tail, table

SCHEMA = "doc_id LONG, text STRING"


def plain_runs(words, min_length, min_exponent):
    """Every period tried on every stretch."""
    n, found = len(words), []
    for q in range(1, n):
        k = 0
        while k + q < n:
            m = k
            while m + q < n and words[m] == words[m + q]:
                m += 1
            length = m - k + q
            if m > k and length >= max(min_length, min_exponent * q):
                shorter = any(
                    all(words[k + t] == words[k + t + p] for t in range(length - p))
                    for p in range(1, q)
                )
                if not shorter:
                    found.append((k, length, q))
            k = m + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def check(found, texts, min_length, min_exponent):
    got = {r["doc_id"]: r for r in found.collect()}
    for i, text in texts:
        words = words_of(text)
        runs = plain_runs(words, min_length, min_exponent)
        assert [tuple(r) for r in got[i]["runs"]] == runs
        assert got[i]["collapsed"] == collapsed(words, runs)
        assert got[i]["n_words"] == len(words)


@pytest.mark.parametrize("least", [(24, 3), (1, 2), (4, 2), (10, 4)])
def test_runs_equal_brute_force(spark, least):
    rng = random.Random(str(least))
    texts = []
    for i in range(150):
        letters = "abcde"[: rng.choice([1, 2, 2, 3, 5])]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        if words and rng.random() < 0.5:
            a, p = rng.randrange(len(words)), rng.randint(1, 9)
            words = [words[j] if j < a else words[min(a + (j - a) % p, len(words) - 1)] for j in range(len(words))]
        texts.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    check(periodic_runs.find_runs(spark.createDataFrame(texts, SCHEMA), *least), texts, *least)


def test_a_long_text_and_texts_that_share_a_task(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice(["é", "b c", "d", "ee"]) for _ in range(400)) + " x y z" * 60_000
    texts = [(1, long), (2, "a b " * 20), (3, "a b " * 20 + "c")]
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert tuple(got[1]["runs"][-1]) == (400, 180_000, 3)
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 40, 2)] == [tuple(r) for r in got[3]["runs"]]
    assert (got[2]["collapsed"], got[3]["collapsed"]) == ("a b", "a b c")


def test_unite_what_is_far_apart():
    # One class of many places, joined in both directions and inside one another.
    words = (["r", "s", "t"] * 10 + ["u"]) * 40 + ["r", "s", "t"] * 9
    _, runs, text = periodic_runs._group_runs([" ".join(words).encode()], 6, 2)
    assert runs[0] == plain_runs(words, 6, 2)
    assert text[0].decode() == collapsed(words, runs[0])


def test_nulls_empty_and_repeated_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n ", "c"), (None, "x " * 30, "d"), (4, "x " * 30, "e"), (4, "x " * 30, "e")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, runs STRING")
    got = sorted(
        ((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.find_runs(docs).collect()),
        key=str,
    )
    run = [(0, 30, 1)]
    assert got == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 30, run, "x"), (4, 30, run, "x"), (4, 30, run, "x")],
        key=str,
    )
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, 3, 1)


def test_query_equals_brute_force(spark, sf_dir):
    got = {r["doc_id"]: r for r in REGISTRY["op11_periodic_runs"](spark, sf_dir).collect()}
    docs = table(spark, sf_dir, "documents").collect()
    assert len(got) == len(docs)
    with_runs = 0
    for doc in docs:
        words = words_of(doc["text"])
        h = zlib.crc32(str(doc["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:  # the plain search takes the square of this
            continue
        runs = plain_runs(words, 24, 3)
        with_runs += bool(runs)
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(runs)
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert (row["start"], row["length"], row["period"]) == top
        assert row["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert with_runs


def test_tails_are_looped_by_id():
    text = b" ".join(b"w%d" % i for i in range(50))
    changed = [i for i in range(200) if looped_tail(i, text) != text]
    assert set(changed) <= {i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0}
    assert changed
    assert looped_tail(None, text) == text and looped_tail(changed[0], b" ") == b" "
