from __future__ import annotations

import os

import corpus_pipeline
import pytest

from rateflow.llm import minhash, packing, quality, secret_scan, toxicity
from rateflow.llm.common import saved
from rateflow.llm.queries import table, tokenizer_file


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """Each stage's input and result."""
    docs, made = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = saved(spark, stage(spark, docs, sf_dir), name)
        made[name] = (docs, out)
        docs = out
    return made


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages_in_order(staged):
    assert list(staged) == ["quality", "toxicity", "near_duplicates", "secrets", "packing"]
    for docs, out in list(staged.values())[:-1]:
        assert out.schema == docs.schema


def test_quality_keeps_what_scores_well(spark, staged, sf_dir):
    docs, out = staged["quality"]
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    good = {r["doc_id"] for r in quality.score_documents(docs, model).where("score >= 0.5").collect()}
    assert rows(out) == [r for r in rows(docs) if r[0] in good]
    assert 0 < len(good) < docs.count()


def test_toxicity_keeps_what_scores_low(spark, staged, sf_dir):
    docs, out = staged["toxicity"]
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    assert rows(out) == [r for r in rows(docs) if lexicon.score(r[1]) < 0.7]


def test_one_of_each_group_stays(staged):
    docs, out = staged["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {i: minhash.shingles_of(minhash.words_of(t), 5) for i, t in texts.items()}
    kept = {r["doc_id"] for r in out.collect()}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert kept == {find(i) for i in sets}


def test_secrets_are_masked_and_no_document_goes(spark):
    # The smallest tables hold no secret.
    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("test tables not present")
    docs = table(spark, sf_dir, "documents")
    out = corpus_pipeline.without_secrets(spark, docs, sf_dir)
    found = secret_scan.find_secrets(spark, docs).where("is_secret").collect()
    assert found
    before = {r["doc_id"]: r for r in docs.collect()}
    after = {r["doc_id"]: r for r in out.collect()}
    assert before.keys() == after.keys()
    for r in found:
        assert r["candidate"] in before[r["doc_id"]]["text"]
        assert r["candidate"] not in after[r["doc_id"]]["text"]
    touched = {r["doc_id"] for r in found}
    assert all(before[i] == after[i] for i in before if i not in touched)
    assert all(r["n_chars"] == len(r["text"]) for i, r in after.items() if i in touched)


def test_packing_places_all_tokens(spark, staged):
    docs, out = staged["packing"]
    pieces = packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json"))
    assert rows(out.select(pieces.columns)) == rows(pieces)


def test_run_gives_the_last_stage(spark, staged, sf_dir):
    made = corpus_pipeline.run(spark, sf_dir)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(made.select(names)) == rows(staged["packing"][1].select(names))


def test_a_table_without_rows(spark, sf_dir, tmp_path):
    for name in ("documents", "labels"):
        table(spark, sf_dir, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert os.path.isdir(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_go_through_all_stages(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    some = docs.where("text IS NOT NULL").orderBy("doc_id").limit(40).collect()
    odd = [
        (None, None, None, None, None), (None, "", "en", "s", 0), (900001, None, "en", None, None),
        (900002, "", None, "s", 0), (900002, "", None, "s", 0), (900003, " \n ", "en", "s", 3),
        (None, some[0]["text"], "en", "s", 1), (900004, "word " * 60_000, "en", "s", 300_000),
        (some[1]["doc_id"], some[1]["text"], "en", "s", 1),
    ]
    rows_ = [tuple(r) for r in some] + odd
    extra = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score DOUBLE, label INT, rep LONG, piece INT"
    spark.createDataFrame([(*r, 0.5, 1, 7, 3) for r in rows_], extra).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, sf_dir, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = saved(spark, stage(spark, docs, str(tmp_path)), name)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
        docs = out
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(some[1]["doc_id"]) <= 1
    packed = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(ids)
    assert sum(r["piece"] == 0 for r in packed) == len(ids)
