from __future__ import annotations

import zlib

import numpy as np
import pytest

from rateflow.llm import quality, toxicity
from rateflow.llm.common import training_sample
from rateflow.llm.queries import REGISTRY, table

BIG = "/root/testdata/sf0.1"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def big():
    import os

    if not os.path.isdir(BIG):
        pytest.skip("test tables not present")
    return BIG


@pytest.mark.parametrize(
    ("name", "label", "accuracy"),
    [("op6_quality_classifier", "quality", 0.98), ("op4_toxicity", "toxic", 0.95)],
)
def test_held_out_accuracy(spark, big, name, label, accuracy):
    scored = REGISTRY[name](spark, big)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == table(spark, big, "documents").count()
    truth = {r["doc_id"]: r[label] for r in table(spark, big, "labels").collect()}
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) >= accuracy


def test_sample_leaves_out_held_out_and_doubtful_labels(spark, documents):
    ids = range(200)
    docs = documents([(i, f"text {i}") for i in ids])
    labels = spark.createDataFrame(
        [(i, i % 2) for i in ids] + [(0, 1), (3, None), (None, 1), (5, 7)], "doc_id LONG, quality INT"
    )
    chosen = training_sample(docs, labels, "quality", 10_000).collect()
    doubtful = {0}
    assert {r["doc_id"] for r in chosen} == {i for i in ids if not held_out(i)} - doubtful
    assert training_sample(docs, labels, "quality", 17).count() == 17


def labelled(spark, documents):
    good = [(i, f"Words that flow on number {i % 7} and rest.") for i in range(300)]
    bad = [(1000 + i, f"BAD!! {'SHOUT!! ' * (i % 5 + 1)}") for i in range(100)]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 1) for i, _ in bad]
    return documents(good + bad), spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")


ODD = [(1, None), (2, ""), (None, "Words that flow on."), (4, "SHOUT!! " * 40_000), (5, " \n"), (5, " \n")]


def test_quality_of_odd_rows(spark, documents):
    model = quality.train(*labelled(spark, documents))
    docs = documents(ODD).selectExpr("*", "0 AS predicted", "1 AS score", "2 AS label")
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == len(ODD)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[1] == score[2] == model.default and score[None] > 0.5 > score[4]
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and 4 not in {r["doc_id"] for r in kept.collect()}
    assert quality.score_documents(documents([]), model).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_training_without_labels_or_with_one_class(spark, documents, module):
    docs, labels = labelled(spark, documents)
    score = quality.score_documents if module is quality else toxicity.score_documents
    for some in (labels.limit(0), labels.where("quality = 1")):
        rows = score(docs.limit(5), module.train(docs, some)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)


def test_training_does_not_depend_on_partitions(spark, documents):
    docs, labels = labelled(spark, documents)
    one = quality.train(docs.repartition(1), labels)
    other = quality.train(docs.repartition(9), labels.repartition(5))
    assert (one.weights == other.weights).all() and one.bias == other.bias


LEXICON = toxicity.Lexicon({"idiot": 2.0, "trash": 2.0, "scum": 1.0, "venom-": 1.5, "fool": 1.0})


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("You IDIOT!", ["IDIOT"]),
        ("1d10t and ïdïôt and іdіоt", ["1d10t", "ïdïôt", "іdіоt"]),
        ("idiot$$$ trash###", ["idiot", "trash"]),
        ("idiots scummy Venomous venom", ["Venom"]),
        ("5cum 7rash ＩＤＩＯＴ", ["5cum", "7rash", "ＩＤＩＯＴ"]),
        ("Put it in the trash can. You fool", ["fool"]),
        ("no fool, a trash  can", ["trash"]),
        ("101 17 $", []),
        ("", []),
        ("İ idiot", ["idiot"]),
    ],
)
def test_matches(text, found):
    assert [text[a:b] for a, b, _ in LEXICON.matches(text)] == found


def test_every_match_of_a_brute_force_is_found():
    import random
    import re

    random.seed(2)
    words = ["idiot", "trash", "scum", "fool", "idiots", "x", "venomous", "venom", "can"]
    for _ in range(200):
        text = "".join(random.choice(words) + random.choice([" ", ", ", "\n", "-"]) for _ in range(20))
        plain = toxicity.Lexicon(LEXICON.weights, ())
        expected = {m.span(1) for m in re.finditer(r"(?<!\w)(idiot|trash|scum|fool)(?!\w)", text)}
        expected |= {m.span(1) for m in re.finditer(r"(?<!\w)(venom)(?=\w)", text)}
        assert {(a, b) for a, b, _ in plain.matches(text)} == expected


def test_score_grows_with_mass_and_falls_with_length():
    lexicon = toxicity.Lexicon(LEXICON.weights, (), (0.0, 1.0, -5.0))
    short, twice = lexicon.score("an idiot " + "word " * 50), lexicon.score("idiot idiot " + "word " * 50)
    assert lexicon.score("an idiot " + "word " * 5000) < short < twice
    assert lexicon.score(None) == lexicon.score("") == lexicon.score("nothing")


def test_toxicity_of_odd_rows(spark, documents):
    docs = documents([*ODD, (8, "idiot " * 50_000)]).selectExpr("*", "1 AS score", "'w' AS word")
    assert toxicity.score_documents(docs, LEXICON).count() == 7
    kept = toxicity.keep_civil(docs, LEXICON)
    assert kept.columns == docs.columns and kept.count() == 6
    spans = toxicity.find_spans(documents([(1, "an idiot"), (2, None)]), LEXICON).collect()
    assert [tuple(r) for r in spans] == [(1, 3, 8, "idiot", 2.0)]


def test_stems_are_learned(spark, documents):
    toxic = [(i, f"text blargh{'abcdef'[i % 6]} number {i}") for i in range(90)]
    clean = [(500 + i, f"text that is fine {i}") for i in range(400)]
    labels = [(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in clean]
    lexicon = toxicity.train(
        documents(toxic + clean), spark.createDataFrame(labels, "doc_id LONG, toxic INT")
    )
    assert "blargh-" in lexicon.weights
    assert lexicon.score("a blarghzzz") > 0.7 > lexicon.score("text that is good")


def test_toxic_words_of_a_small_group_are_learned(spark, documents):
    common = [(i, f"gribble says number {i}") for i in range(1000)]
    rare = [(10_000 + i, f"zworp sagt nummer {i}") for i in range(16)]
    clean = [(20_000 + i, f"somebody says sagt number nummer {i}") for i in range(6000)]
    labels = spark.createDataFrame(
        [(i, int(i < 20_000)) for i, _ in common + rare + clean], "doc_id LONG, toxic INT"
    )
    lexicon = toxicity.train(documents(common + rare + clean), labels)
    assert lexicon.score("zworp sagt nummer 7") > lexicon.score("somebody sagt nummer 7")


def test_sample_is_bounded_where_an_id_repeats(spark, documents):
    usable = [i for i in range(60) if not held_out(i)]
    docs = documents([(usable[0], f"text {i % 100}") for i in range(5_000)] + [(i, "other") for i in usable[1:]])
    labels = spark.createDataFrame([(i, i % 2) for i in usable], "doc_id LONG, quality INT")
    for n in (5, 17):
        chosen = training_sample(docs, labels, "quality", n).collect()
        assert len(chosen) == n == len({r["doc_id"] for r in chosen})
    whole = training_sample(docs.repartition(7), labels, "quality", 1000).collect()
    assert sorted(whole) == sorted(training_sample(docs, labels, "quality", 1000).collect())


def test_long_words_are_learned(spark, documents):
    long = "grobnik" * 10
    docs = documents([(i, f"some words {i} {long if i % 2 else 'fine'} and more") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id LONG, toxic INT")
    lexicon = toxicity.train(docs, labels)
    assert any(entry.rstrip("-") == long[: len(entry.rstrip("-"))] for entry in lexicon.weights if entry.startswith("grobnik"))
    assert lexicon.score(f"you {long} there") > lexicon.score("you fine there")


def test_exceptions_inside_one_another(spark):
    phrases = tuple("idiot " + "x " * n + "end" for n in range(1, 30))
    lexicon = toxicity.Lexicon({"idiot": 5.0, "x": 1.0, "end": 1.0}, phrases + ("the idiot",))
    assert lexicon.matches("idiot " + "x " * 29 + "end") == []
    assert [m[:2] for m in lexicon.matches("the idiot x end of idiot x")] == [(19, 24), (25, 26)]
    text = "x idiot x x x end x"
    assert [m[:2] for m in lexicon.matches(text)] == [(0, 1), (18, 19)]
