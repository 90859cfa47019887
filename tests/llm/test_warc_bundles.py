from __future__ import annotations

import glob
import hashlib
import io

import pyarrow as pa
import pytest
import zstandard

from rateflow.llm import warc_bundles
from rateflow.llm.oracle import ORACLE_SQL
from rateflow.llm.queries import REGISTRY

LONG = "<p>" + "ä" * 120
SCHEMA = "page_id LONG, url STRING, html STRING"
ROWS = [
    (5, "http://a/5", LONG),
    (3, "http://a/3\r\nWARC-Type: x", LONG),
    (9, None, LONG),
    (None, "http://a/n", LONG),
    (3, "http://a/3b", LONG),
    (1, "http://a/1", "short"),
    (2, "http://a/2", "short"),
    (7, "http://a/7", None),
    (8, "http://a/8", ""),
    (None, None, LONG + "1"),
    (None, None, LONG + "1"),
    (-4, "http://a/-4", "x" * 3_000_000),
    (11, "http://a/11", "WARC/1.1\r\n\r\nHTTP\r\n\r\n" + "y" * 200),
]


@pytest.fixture
def archive(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumnRenamed("url", "url")
    records = warc_bundles.capture_records(spark, pages)
    return warc_bundles.write_bundles(
        spark, records, f"{tmp_path}/warc", frame_bytes=1000, bundle_bytes=1500
    )


def expected():
    firsts = {}
    for page, _, html in ROWS:
        if page is not None:
            firsts[html] = min(page, firsts.get(html, page))
    found = []
    for page, _, html in ROWS:
        payload = (html or "").encode()
        first = firsts.get(html) if len(payload) >= 100 else None
        revisit = first is not None and page != first
        digest = hashlib.sha256(payload).hexdigest()
        found.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(found, key=str)


def summary(read):
    rows = read.select(
        warc_bundles.page_of(read["record_id"]).alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        warc_bundles.page_of(read["refers_to"]).alias("refers_to"),
    ).collect()
    return sorted(map(tuple, rows), key=str)


def test_all_records_come_back(spark, archive):
    read = warc_bundles.read_bundles(spark, archive)
    assert summary(read) == expected()
    for row in read.collect():
        if row["record_type"] == "response":
            assert hashlib.sha256(row["payload"]).hexdigest() == row["payload_digest"]
            assert len(row["payload"]) == row["payload_bytes"]
        else:
            assert row["payload"] is None
    urls = {r["target_uri"] for r in read.collect()}
    assert "http://a/3%0D%0AWARC-Type:%20x" in urls and None in urls


def test_bundles_are_plain_streams_of_records_with_a_seek_table(archive):
    paths = glob.glob(f"{archive.path}/*.warc.zst")
    assert len(paths) > 1  # rolled over
    records = 0
    for path in paths:
        content = open(path, "rb").read()
        reader = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True)
        whole = reader.read()
        found = list(warc_bundles.split_records(whole))
        assert b"".join(found) == whole
        records += sum(warc_bundles.parse_record(r)[1] != "warcinfo" for r in found)
        table = warc_bundles.seek_table(pa.BufferReader(content))
        assert sum(unpacked for _, _, unpacked in table) == len(whole)
        assert [at for at, _, _ in table] == [sum(p for _, p, _ in table[:k]) for k in range(len(table))]
        assert content[sum(p for _, p, _ in table) :][:4] == b"\x5e\x2a\x4d\x18"
    assert records == len(ROWS)


def test_single_records_by_the_index(spark, archive):
    index = archive.index.collect()
    assert len(index) == len(ROWS)
    wanted = spark.createDataFrame([(r["record_id"],) for r in index if ":-4:" in r["record_id"] or ":1:" in r["record_id"]] + [("urn:none",), (None,)], "record_id STRING")
    got = {r["record_id"].split(":")[2]: r["payload"] for r in warc_bundles.fetch_records(archive, wanted).collect()}
    assert got == {"-4": b"x" * 3_000_000, "1": b"short"}


def test_files_of_other_attempts_are_not_read(spark, archive):
    with open(f"{archive.path}/part-000000-99999-0000.warc.zst", "wb") as file:
        file.write(b"half a bundle")
    assert warc_bundles.read_bundles(spark, archive).count() == len(ROWS)


def test_frames_hold_several_records_and_stand_alone():
    stream = io.BytesIO()
    stream.close_ = stream.close
    stream.close = lambda: None
    writer = warc_bundles.BundleWriter(stream, "b", 100)
    for i in range(10):
        writer.add(f"r{i}", b"%d" % i * 30)
    writer.close()
    file = pa.BufferReader(stream.getvalue())
    assert [unpacked for _, _, unpacked in warc_bundles.seek_table(file)] == [90, 90, 90, 30]
    for name, _, _, at, size, offset, length in writer.placed:
        frame = warc_bundles.read_frame(file, at, size)
        assert frame[offset : offset + length] == name[1:].encode() * 30


@pytest.mark.parametrize("content", [b"", b"123456789", b"x" * 100])
def test_what_is_no_bundle_is_refused(content):
    with pytest.raises(ValueError):
        warc_bundles.seek_table(pa.BufferReader(content))


def test_a_table_without_rows(spark):
    pages = spark.createDataFrame([], SCHEMA + ", record_id STRING, payload STRING")
    archive = warc_bundles.write_bundles(spark, warc_bundles.capture_records(spark, pages))
    assert warc_bundles.read_bundles(spark, archive).count() == 0


def test_shuffled_look_up_gives_the_same(spark, monkeypatch):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    names = ["record_id", "record_type", "refers_to"]
    key = lambda r: tuple(map(str, r))
    one = sorted(map(tuple, warc_bundles.capture_records(spark, pages).select(names).collect()), key=key)
    monkeypatch.setattr(warc_bundles, "BROADCAST_DIGESTS", -1)
    two = sorted(map(tuple, warc_bundles.capture_records(spark, pages).select(names).collect()), key=key)
    assert one == two


def test_query_equals_sql(spark, sf_dir, duck, same_rows):
    same_rows(REGISTRY["op12_warc_bundles"](spark, sf_dir), duck.sql(ORACLE_SQL["op12_warc_bundles"]))
