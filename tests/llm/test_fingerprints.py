from __future__ import annotations

import hashlib
import random

from rateflow.llm.fingerprints import (
    Fingerprint,
    edited,
    edited_neighbours,
    fingerprint_documents,
    units,
)
from rateflow.llm.queries import REGISTRY, table


def text_of(parts):
    return "\n".join(parts)


def test_order_of_units_does_not_matter_but_their_number_does():
    parts = [f"paragraph {i}" for i in range(20)]
    shuffled = random.Random(1).sample(parts, len(parts))
    assert Fingerprint.of_text(text_of(parts)) == Fingerprint.of_text(text_of(shuffled))
    assert Fingerprint.of_text(text_of(parts)) != Fingerprint.of_text(text_of([*parts, parts[0]]))


def test_insertion_and_deletion_are_addition_and_subtraction():
    a, b = ["one", "two", "two"], ["three", "one"]
    both = Fingerprint.of([*a, *b])
    assert Fingerprint.of(a) + Fingerprint.of(b) == both
    assert both - Fingerprint.of(b) == Fingerprint.of(a)
    assert Fingerprint.from_hex(both.hex()) == both


def test_likeness_follows_the_share_of_common_units():
    for shared in (0, 25, 50, 75, 100):
        a = [f"u{i}" for i in range(100)]
        b = a[:shared] + [f"v{i}" for i in range(100 - shared)]
        found = Fingerprint.of(a).likeness(Fingerprint.of(b))
        assert abs(found - shared / 100) < 0.3 and (found == 1.0) == (shared == 100)
    empty = Fingerprint.of([])
    assert empty.likeness(empty) == 1.0 and empty.likeness(Fingerprint.of(["x"])) == 0.0


def expected(rows):
    order = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()),
    )
    found = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        changed = edited(text, following)
        own, other = Fingerprint.of_text(text), Fingerprint.of_text(changed)
        found.append((
            str(i), len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), other.hex(),
            own.likeness(other), own.likeness(Fingerprint.of_text(following)),
        ))
    return sorted(found)


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_query_matches_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert rows_of(REGISTRY["op3_document_fingerprints"](spark, sf_dir)) == expected(rows)


def test_odd_rows(spark, documents):
    rows = [(3, "a b. c\nd"), (None, "x"), (3, "a b. c\nd"), (3, "other"), (7, None), (1, ""),
            (9, "é🙂 " * 30_000), (None, None)]
    docs = documents(rows).repartition(4).selectExpr("*", "1 AS part", "'t' AS tie", "2 AS at")
    assert rows_of(edited_neighbours(spark, docs)) == expected(rows)


def test_one_row_is_its_own_next_and_no_rows_give_none(spark, documents):
    assert rows_of(edited_neighbours(spark, documents([(1, "abcd")]))) == expected([(1, "abcd")])
    assert edited_neighbours(spark, documents([])).count() == 0


def test_fingerprint_documents(spark, documents):
    made = fingerprint_documents(documents([(1, "a. b\nc"), (2, None)])).collect()
    assert [(r["doc_id"], r["n_units"]) for r in made] == [(1, 3), (2, 0)]
    assert units("a. b\n\n c ") == ["a.", "b", " c "]


def test_likeness_of_a_line_repeated_often(spark, documents):
    line = "The same line again.\n"
    long, kept = Fingerprint.of_text(line * 40_000), Fingerprint.of_text(line * 20_000)
    assert long.likeness(kept) > 0.99 and kept.likeness(long) > 0.99
    assert long - kept == kept and Fingerprint.from_hex(long.hex()) == long
    rows = [(1, line * 40_000 + "x"), (2, "Another text.\n" * 40_000)]
    near = {r["doc_id"]: r["near_edited"] for r in edited_neighbours(spark, documents(rows)).collect()}
    assert min(near.values()) > 0.5
