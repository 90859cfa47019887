"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm import (
    chat_format,
    embedding_dedup,
    fingerprints,
    license_scan,
    minhash,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    sentencepiece_codec,
    toxicity,
    warc_bundles,
    whitening,
)
from rateflow.llm.common import crc_remainder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Texts are long, so Arrow batches are set to a tenth of the
    default number of rows where the session has that default."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_held_out(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(crc_remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(
        spark, table(spark, sf_dir, "embeddings"), similarity=0.98
    )


@query
def op2_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.round_trips(
        table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")
    )
    return coded.select(
        "doc_id", "n_pieces", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), "same"
    )


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(spark, table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return with_held_out(toxicity.score_documents(docs, lexicon, threshold=0.7))


@query
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = secret_scan.find_secrets(spark, table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id",
        "nth",
        F.length("candidate").alias("n_chars"),
        F.sha2("candidate", 256).alias("candidate_sha256"),
        "probability",
        "is_secret",
    )


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return with_held_out(quality.score_documents(docs, model, threshold=0.5))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(
        spark, table(spark, sf_dir, "documents"), width=2, percent=80
    )


#: A conversation whose texts are marks of other templates.
MARKED_CONVERSATION = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED_CONVERSATION, "conv_id LONG, turn LONG, role STRING, text STRING")
    records = chat_format.turn_records(rows.unionByName(marked))
    return chat_format.read_back(chat_format.format_records(records))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(
        table(spark, sf_dir, "documents"),
        tokenizer_file("word_bpe_49k.json"),
        capacity=2048,
        end_id=0,
    )
    return packing.pack(spark, pieces, capacity=2048)


@query
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark, table(spark, sf_dir, "documents"))


def looped_tail(doc_id: int | None, text: bytes) -> bytes:
    """The text with its words from a place on repeated, if its id says so."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    words = text.split() if h % 10 == 0 else []
    if not words:
        return text
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(
        table(spark, sf_dir, "documents"), min_length=24, min_exponent=3, prepare=looped_tail
    )
    # Of equal exponents the first stays: runs are in order of start and period.
    top = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
    lines = F.transform(
        "runs",
        lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")),
    )
    return found.select("*", top.alias("top")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_bundles.capture_records(spark, table(spark, sf_dir, "pages"))
    read = warc_bundles.read_bundles(spark, warc_bundles.write_bundles(spark, records))
    # A response's digest and size are those of the payload that came back.
    whole = F.col("record_type") == "response"
    return read.select(
        warc_bundles.page_of(F.col("record_id")).alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long"))
        .otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        "record_type",
        warc_bundles.page_of(F.col("refers_to")).alias("refers_to"),
    )


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"), components=4)
