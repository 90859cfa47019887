"""The corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of
``documents``, and any others there are, whatever their names.

Every stage takes nulls in any column, empty texts, repeated rows and a table
without rows: a null text counts as empty, and each repeated row is a document of
its own, but for near duplicates, which keep one row an id. Rows without doc_id
are never near duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateflow.llm import minhash, packing, quality, secret_scan, toxicity
from rateflow.llm.common import saved
from rateflow.llm.queries import table, tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Empty texts score the
    share of good ones among the training rows, and stay or go by that."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, threshold=0.5)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon does not reject; empty texts stay."""
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_civil(docs, lexicon, threshold=0.7)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8): the
    smallest doc_id. Documents without words, and rows without doc_id, all stay."""
    return minhash.keep_one(spark, docs, width=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mask and ``n_chars`` adjusted;
    a null text stays null."""
    return secret_scan.redact(spark, docs, secret_scan.find_secrets(spark, docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces, placed in sequences of at most 2048 tokens. An
    empty or null text is a piece of its end sign alone."""
    # Smaller caches than packing alone takes: workers of other stages wait beside.
    pieces = packing.token_pieces(
        docs, tokenizer_file("word_bpe_49k.json"), cached=(120_000, 60_000)
    )
    return packing.pack(spark, pieces)


STAGES = [
    ("quality", good_quality),
    ("toxicity", civil),
    ("near_duplicates", distinct),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Trained models decide what stays, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
