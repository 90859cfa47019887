"""WARC archives as seekable Zstandard bundles.

A bundle is a ``.warc.zst`` file: records are grouped into frames that can be
read each by itself, and a table in a last, skippable frame gives every frame's
size (the seekable format of Zstandard's contributors; plain readers see one
stream of records). An index maps each record's identifier to its bundle, the
place of its frame and the record's offset inside the frame.

Tasks write bundles straight to a folder that all machines reach. Their names
hold the attempt that wrote them, and only the index, which Spark commits, says
which files count: what a lost or repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import saved
from rateflow.session import scratch_path

#: Bytes of records in a frame and, compressed, in a bundle; a longer record
#: has a frame of its own.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 128 << 20
#: Payloads below this are written again rather than referred to.
REVISIT_BYTES = 100
#: Digests of repeated payloads that are broadcast at most (some 10 MB).
BROADCAST_DIGESTS = 100_000
#: Bytes of records that one task reads.
READ_BYTES = 16 << 20

# Fixed values of the seekable format and of the archive format.
_SKIPPABLE_MAGIC, _SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = (
    "record_id STRING, bundle STRING, frame INT, frame_offset LONG, frame_bytes LONG,"
    " record_offset LONG, record_bytes LONG"
)
_RECORD = (
    "record_id STRING, record_type STRING, target_uri STRING, refers_to STRING,"
    " payload_digest STRING, payload_bytes LONG, payload BINARY"
)
_INDEX_TYPES = [
    pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
]
_RECORD_TYPES = [
    pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(),
]


@dataclass(frozen=True)
class Archive:
    """A folder of bundles, and the index of the records that count."""

    path: str
    index: DataFrame


def capture_records(spark: SparkSession, pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The records to write for ``pages (page_id, url, html)``, one a row.

    Of pages with equal payloads of ``revisit_bytes`` or more, those with the
    smallest page_id are responses and the others revisit it; all smaller ones
    are responses. A null html is an empty payload. A null page_id is greater
    than any other; where all of a group are null, all are responses. A repeated
    row is a record of its own, with the same identifier.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = pages.select("page_id", "url", payload.alias("payload")).select(
        "*",
        F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    # Only payloads that occur twice need a look-up, and a hot one is one row.
    firsts = saved(
        spark,
        digested.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select(F.col("payload_digest").alias("repeated"), "first_id"),
        "first-captures",
    )
    if firsts.count() <= BROADCAST_DIGESTS:
        firsts = F.broadcast(firsts)
    joined = digested.join(firsts, digested["payload_digest"] == firsts["repeated"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        record_id(F.col("page_id"), F.col("payload_digest")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").cast("string").alias("target_uri"),
        F.when(revisit, record_id(F.col("first_id"), F.col("payload_digest"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record_id(page_id: Column, payload_digest: Column) -> Column:
    name = F.coalesce(page_id.cast("string"), F.lit("none"))
    return F.concat(F.lit("urn:page:"), name, F.lit(":"), F.substring(payload_digest, 1, 16))


def page_of(identifier: Column) -> Column:
    """The page_id that a record's identifier names."""
    return F.regexp_extract(identifier, r"^urn:page:(-?\d+):", 1).try_cast("long")


def write_bundles(
    spark: SparkSession,
    records: DataFrame,
    path: str | None = None,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> Archive:
    """Write ``capture_records`` as bundles to ``path`` (default: a new folder in
    the shared one) and return them with their index.

    ``date`` is every record's WARC-Date, so that an attempt made again writes
    the same bytes. Control characters and spaces of a URL are percent-encoded;
    a null URL is left out. An empty table makes no bundle.
    """
    folder = path or scratch_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        attempt = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        writer, number = None, 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                if writer is None:
                    name = f"{attempt}-{number:04d}.warc.zst"
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                    writer = BundleWriter(stream, name, frame_bytes)
                    writer.add(None, info_record(name, date))
                    writer.flush()
                writer.add(row["record_id"], record_bytes(row, date))
                if writer.size >= bundle_bytes:
                    writer.close()
                    yield _batch(_INDEX_TYPES, _INDEX, writer.placed)
                    writer, number = None, number + 1
        if writer is not None:
            writer.close()
            yield _batch(_INDEX_TYPES, _INDEX, writer.placed)

    return Archive(folder, saved(spark, records.mapInArrow(run, _INDEX), "warc-index"))


def read_bundles(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record of the archive's bundles, from their seek tables.

    ``(record_id, record_type, target_uri, refers_to, payload_digest,
    payload_bytes, payload)``; the digest and the size are those that the
    record states. Frames are dealt out one by one, so a large bundle is many
    tasks' work.
    """
    folder = archive.path

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with store.open_input_file(f"{root}/{name}") as file:
                    rows = [(name, at, size) for at, size, _ in seek_table(file)]
                yield _batch([pa.string(), pa.int64(), pa.int64()], "bundle, frame_offset, frame_bytes", rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for name, at, size in _rows(batches):
            with store.open_input_file(f"{root}/{name}") as file:
                content = read_frame(file, at, size)
            found = [r for r in map(parse_record, split_records(content)) if r[1] != "warcinfo"]
            yield _batch(_RECORD_TYPES, _RECORD, found)

    size = archive.index.agg(F.sum("record_bytes")).first()[0] or 0
    places = archive.index.select("bundle").distinct().mapInArrow(
        frames, "bundle STRING, frame_offset LONG, frame_bytes LONG"
    )
    dealt = places.repartition(max(1, -(-size // READ_BYTES)), "bundle", "frame_offset")
    return dealt.mapInArrow(read, _RECORD)


def fetch_records(archive: Archive, record_ids: DataFrame) -> DataFrame:
    """The records named in the column ``record_id``, once each: only the frames
    that hold them are read, each in one go. Unknown names give no row."""
    folder = archive.path
    wanted = record_ids.select("record_id").where(F.col("record_id").isNotNull()).distinct()
    places = archive.index.join(wanted, "record_id", "left_semi").dropDuplicates(["record_id"])
    order = ["bundle", "frame_offset", "record_offset"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        held, content = None, b""
        for name, at, size, offset, length in _rows(batches):
            if held != (name, at):
                with store.open_input_file(f"{root}/{name}") as file:
                    held, content = (name, at), read_frame(file, at, size)
            yield _batch(_RECORD_TYPES, _RECORD, [parse_record(content[offset : offset + length])])

    dealt = places.repartition("bundle", "frame_offset").sortWithinPartitions(*order)
    return dealt.select(
        "bundle", "frame_offset", "frame_bytes", "record_offset", "record_bytes"
    ).mapInArrow(read, _RECORD)


class BundleWriter:
    """Records into independent frames of a stream, and at the end their sizes.

    ``placed`` holds the index rows of the records in finished frames.
    """

    def __init__(self, stream, name: str, frame_bytes: int) -> None:
        self._stream, self._name, self._limit = stream, name, frame_bytes
        self._compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self._held: list[tuple[str | None, bytes]] = []
        self._held_bytes = 0
        self._frames: list[tuple[int, int]] = []
        self.size = 0
        self.placed: list[tuple] = []

    def add(self, name: str | None, record: bytes) -> None:
        if self._held and self._held_bytes + len(record) > self._limit:
            self.flush()
        self._held.append((name, record))
        self._held_bytes += len(record)

    def flush(self) -> None:
        if not self._held:
            return
        frame = self._compressor.compress(b"".join(record for _, record in self._held))
        offset = 0
        for name, record in self._held:
            if name is not None:
                place = (len(self._frames), self.size, len(frame), offset, len(record))
                self.placed.append((name, self._name, *place))
            offset += len(record)
        self._stream.write(frame)
        self._frames.append((len(frame), offset))
        self.size += len(frame)
        self._held, self._held_bytes = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self._frames)
        table += struct.pack("<IBI", len(self._frames), 0, _SEEKABLE_MAGIC)
        self._stream.write(struct.pack("<II", _SKIPPABLE_MAGIC, len(table)) + table)
        self._stream.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """``(offset, bytes, bytes unpacked)`` of each frame, from the file's end."""
    end = file.size()
    if end < 9:
        raise ValueError("not a seekable bundle")
    count, descriptor, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != _SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    entry = 12 if descriptor & 0x80 else 8  # with a checksum an entry
    start = end - 9 - entry * count
    head = struct.unpack("<II", file.read_at(8, start - 8)) if start >= 8 else None
    if head != (_SKIPPABLE_MAGIC, entry * count + 9):
        raise ValueError("damaged seek table")
    table = file.read_at(entry * count, start)
    places, at = [], 0
    for nth in range(count):
        packed, unpacked = struct.unpack_from("<II", table, nth * entry)
        places.append((at, packed, unpacked))
        at += packed
    return places


def read_frame(file, offset: int, size: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(file.read_at(size, offset))


def info_record(bundle: str, date: str) -> bytes:
    return _record(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:bundle:{bundle}>"),
            ("WARC-Date", date),
            ("WARC-Filename", bundle),
            ("Content-Type", "application/warc-fields"),
        ],
        b"software: rateflow\r\nformat: WARC File Format 1.1\r\n",
    )


def record_bytes(row: dict, date: str) -> bytes:
    """A response with its payload, or a revisit with the response's headers."""
    revisit = row["record_type"] == "revisit"
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["target_uri"] is not None:
        fields.append(("WARC-Target-URI", _encoded(row["target_uri"])))
    if revisit:
        fields.append(("WARC-Profile", _REVISIT_PROFILE))
        fields.append(("WARC-Refers-To", f"<{row['refers_to']}>"))
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    )
    return _record(fields, head.encode() + (row["payload"] or b""))


def _record(fields: Iterable[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in (*fields, ("Content-Length", len(block)))]
    return f"WARC/1.1\r\n{''.join(lines)}\r\n".encode() + block + b"\r\n\r\n"


def _encoded(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda sign: f"%{ord(sign[0]):02X}", url)


def split_records(content: bytes) -> Iterator[bytes]:
    """The records of an unpacked frame, by their stated lengths."""
    at = 0
    while at < len(content):
        head, body = _head(content, at)
        end = body + int(head["content-length"]) + 4
        if end > len(content):
            raise ValueError("a record is cut short")
        yield content[at:end]
        at = end


def parse_record(record: bytes) -> tuple:
    """The columns of ``read_bundles``. A revisit has no payload of its own; the
    size is that of the payload it stands for."""
    head, body = _head(record, 0)
    block = record[body : body + int(head["content-length"])]
    size = payload = None
    if head["content-type"].startswith("application/http"):
        http, payload = block.split(b"\r\n\r\n", 1)
        size = int(_fields(http.split(b"\r\n")[1:])["content-length"])
    if head["warc-type"] == "revisit":
        payload = None
    return (
        head["warc-record-id"].strip("<>"),
        head["warc-type"],
        head.get("warc-target-uri"),
        head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
        head.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        size,
        payload,
    )


def _head(content: bytes, at: int) -> tuple[dict[str, str], int]:
    end = content.find(b"\r\n\r\n", at)
    lines = content[at:end].split(b"\r\n")
    if end < 0 or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    return _fields(lines[1:]), end + 4


def _fields(lines: Iterable[bytes]) -> dict[str, str]:
    pairs = (line.decode().split(":", 1) for line in lines)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batch(types: list[pa.DataType], schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [column.split()[0] for column in schema.split(",")]
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
