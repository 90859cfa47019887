"""SentencePiece encoding and decoding: an automaton over pieces drives Viterbi.

An Aho-Corasick automaton of all pieces reads a text once. At each position it
names, along its output links, every piece that ends there, and each relaxes the
best score of the position by that of its start: the segmentation with the
highest sum of piece scores, in one pass. A character that no piece covers is
unknown, or its bytes where the model has byte pieces.

Texts are cut where no piece can cross, and what was met lately is kept, so that
most words cost one look-up.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rateflow.llm.common import Recent, sliced, worker_cache

SPACE = "▁"
#: How much worse than the worst piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
#: Segments whose ids a Python worker keeps at most, in two generations.
CACHED_SEGMENTS = 250_000


class SentencePieceCodec:
    """Encoder and decoder of a SentencePiece model's vocabulary.

    Of segmentations with one score, that with the longest last piece is taken,
    and so on towards the front. Text is normalised by the model's own rules;
    the space sign itself, and what normalisation drops, does not come back.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self._plain = [
            i for i in ids
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): i for i in self._plain}
        self._automaton = ahocorasick.Automaton()
        for piece, i in pieces.items():
            self._automaton.add_word(piece, (len(piece), i, model.get_score(i)))
        self._automaton.make_automaton()
        self._unknown = model.unk_id()
        self._unknown_score = min(model.get_score(i) for i in self._plain) - UNKNOWN_PENALTY
        self._bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        self._text = [model.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        for i in ids:
            if model.is_control(i):
                self._text[i] = b""
        for value, i in self._bytes.items():
            self._text[i] = bytes([value])
        # The model writes the unknown piece as it decodes it.
        self._text[self._unknown] = model.decode([self._unknown]).encode()
        self._prefix = model.normalize("a") == SPACE + "a"
        # With rules that change texts, normalisation is the model's, text by text.
        self._identity = model.normalize(" a  éﬁ① ").removeprefix(
            SPACE if self._prefix else ""
        ) == " a  éﬁ① ".replace(" ", SPACE)
        crossing = any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        lines = any("\n" in piece for piece in pieces)
        self._cut = re.compile(
            "(?s:.+)" if crossing or lines else f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+"
        )
        self._segments = Recent(CACHED_SEGMENTS, self._segment)

    def normalize(self, text: str) -> str:
        if not self._identity:
            return self._model.normalize(text)
        plain = text.replace(" ", SPACE)
        return SPACE + plain if self._prefix and text else plain

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit bytes."""
        found = b"".join(map(self._segments.__getitem__, self._cut.findall(self.normalize(text))))
        self._segments.trim()
        return found

    def decode(self, ids: bytes) -> str:
        parts = self._text
        data = b"".join([parts[i] for i in np.frombuffer(ids, "<u4").tolist()])
        if self._prefix:
            data = data.removeprefix(b" ")
        return data.decode("utf-8", "replace")

    def _segment(self, text: str) -> bytes:
        return array("I", self.segment(text)).tobytes()

    def segment(self, text: str) -> list[int]:
        """Viterbi over one stretch of normalised text."""
        n = len(text)
        unknown_score = self._unknown_score
        best = [0.0] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        at = 0  # positions up to here are settled
        for last, (length, piece, score) in self._automaton.iter(text):
            end = last + 1
            while at < end:
                # A single character is always reachable, if only as unknown.
                best[at + 1] = best[at] + unknown_score
                back[at + 1] = (at, -1)
                at += 1
            candidate = best[end - length] + score
            if candidate > best[end] or (
                candidate == best[end] and (back[end][1] < 0 or end - length < back[end][0])
            ):
                best[end] = candidate
                back[end] = (end - length, piece)
        while at < n:
            best[at + 1] = best[at] + unknown_score
            back[at + 1] = (at, -1)
            at += 1
        ids: list[int] = []
        end, was_unknown = n, False
        while end:
            start, piece = back[end]
            if piece >= 0:
                ids.append(piece)
            elif self._bytes:
                ids.extend(self._bytes[b] for b in reversed(text[start:end].encode()))
            elif not was_unknown:
                ids.append(self._unknown)  # unknown characters in a row are one
            was_unknown = piece < 0
            end = start
        ids.reverse()
        return ids


def _codec(path: str) -> SentencePieceCodec:
    kept = worker_cache("sentencepiece")
    if path not in kept:
        kept[path] = SentencePieceCodec(path)
    return kept[path]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, ids)``: little-endian unsigned 32-bit ids of every row.

    A null or empty text has none. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in sliced(batches, owner="sentencepiece"):
            ids = [codec.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary())}
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id LONG, ids BINARY")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, text)`` of rows of ids; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in sliced(batches, owner="sentencepiece"):
            texts = [codec.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())}
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id LONG, text STRING")


def round_trips(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_pieces, ids_crc32, decoded, same)`` of every row.

    ``decoded`` is the text read back from the ids, and ``same`` whether it is
    the row's text (null counts as empty).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in sliced(batches, owner="sentencepiece"):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = [codec.encode(text) for text in texts]
            decoded = [codec.decode(i) for i in ids]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_pieces": pa.array([len(i) // 4 for i in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                    "decoded": pa.array(decoded, pa.string()),
                    "same": pa.array([a == b for a, b in zip(texts, decoded)], pa.bool_()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id LONG, n_pieces LONG, ids_crc32 LONG, decoded STRING, same BOOLEAN"
    )
