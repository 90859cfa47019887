import io
import zipfile

import pytest
from pyspark.sql import functions as F

from rateflow.plans.clean import clean_observations, parse_observations, rejected_files
from rateflow.sources import archives, headed_csv, json_payloads, raw_csv, tables, wide_tables

WIDE = "FREQ,Series,2023,2023-Q2,2023-S1\nA,X:1,1.0,2.0,3.0\nA,Y:2,4.0,5.0,6.0\n"


# JSON payloads

def test_json_files(spark, rows, day, tmp_path):
    (tmp_path / "DGS10.json").write_text(
        '{"observations": [{"date": "2024-01-01", "value": "4.0"},\n'
        '{"date": "2024-01-02", "value": "."}, {"date": "2024-01-03", "value": "4.2"}]}'
    )
    payloads = json_payloads.read_json_payloads(spark, str(tmp_path))
    found = json_payloads.json_observations(payloads).select("series_id", "date", "value")
    assert rows(found) == [("DGS10", day("2024-01-01"), 4.0), ("DGS10", day("2024-01-03"), 4.2)]


def test_unsound_payloads_are_set_aside(spark, rows):
    payloads = spark.createDataFrame(
        [
            ("ok", '{"observations": [{"date": "2024-01", "value": "1"}, {"date": null, "value": "2"}]}'),
            ("error", '{"error_message": "bad key"}'),
            ("broken", '{"observations": [{'),
            ("none", '{"observations": []}'),
            ("bad", '{"observations": [{"date": "soon", "value": "1"}]}'),
            ("mixed", '{"observations": [{"date": "2024-01", "value": "1"}, {"date": "2024-01-01", "value": "1"}]}'),
        ],
        "series_file STRING, payload STRING",
    )
    assert rows(json_payloads.json_observations(payloads).select("series_id", "value")) == [("ok", 1.0), ("ok", 2.0)]
    assert rows(json_payloads.rejected_payloads(payloads)) == [
        ("bad", "bad_date"), ("broken", "no_observations"), ("error", "no_observations"),
        ("mixed", "mixed_date_layouts"), ("none", "no_observations"),
    ]


# Statistics CSV

def test_sdmx_csv(spark, rows, day, tmp_path):
    (tmp_path / "EURIBOR_3M.csv").write_text(
        'KEY,TIME_PERIOD,OBS_VALUE,TITLE\nk,2024-01,3.9,"a, ""b"""\nk,2024-02,,x\nk,2024-03,3.8,x\n'
    )
    parsed = parse_observations(raw_csv.read_sdmx_csv(spark, str(tmp_path)))
    assert rows(parsed.select("series_id", "date", "value")) == [
        ("EURIBOR_3M", day("2024-01-01"), 3.9), ("EURIBOR_3M", day("2024-03-01"), 3.8),
    ]


def test_sdmx_csv_without_observations(spark, tmp_path):
    (tmp_path / "X.csv").write_text("message\nnot found\n")
    with pytest.raises(ValueError, match="OBS_VALUE"):
        raw_csv.read_sdmx_csv(spark, str(tmp_path))


# Raw CSV

def test_raw_csv_directory(spark, rows, day, tmp_path):
    (tmp_path / "GOOD.csv").write_text("date,value,series_id\n2024-01-02,2.0,GOOD\n2024-01-01,1.0,GOOD\n2024-01-01,9.0,GOOD\n")
    (tmp_path / "BAD.csv").write_text("date,value,series_id\n2024-01-01,1.0,BAD\nnot-a-date,2.0,BAD\n")
    (tmp_path / "notes.txt").write_text("ignored")
    raw = raw_csv.read_raw_csv(spark, str(tmp_path))
    assert rows(clean_observations(raw)) == [
        ("GOOD", "GOOD", day("2024-01-01"), 9.0), ("GOOD", "GOOD", day("2024-01-02"), 2.0),
    ]
    assert rows(rejected_files(raw)) == [("BAD", "bad_date")]


def test_missing_directories_are_empty(spark, tmp_path):
    missing = str(tmp_path / "none")
    for frame in (
        raw_csv.read_raw_csv(spark, missing),
        raw_csv.read_partitioned_raw_csv(spark, missing),
        tables.read_observations(spark, missing),
    ):
        assert "series_id" in frame.columns and frame.count() == 0


def test_headings_of_every_layout_in_one_directory(spark, rows, day, tmp_path):
    for name, text in {
        "PLAIN": "date,value,series_id\n2024-01-01,1.0,PLAIN\n",
        "TURNED": "series_id,date,value\nTURNED,2024-01-01,2.0\nTURNED,2024-01-01,2.5\n",
        "MORE": '\ufeffnote,"value",status,date,series_id,\n"a, ""b""",3.0,x,2024-01-01,MORE,\nc,4.0,x,2024-01-02,MORE\n',
        "BLANK_FIRST": "\n\nvalue,date,series_id\n5.0,2024-01-01,BLANK_FIRST\n",
        "TWICE": "value,date,series_id,value\n6.0,2024-01-01,TWICE,7.0\n",
        "SHORT": "date,value,series_id\n2024-01-01,8.0\n",
        "NO_ID": "date,value\n2024-01-01,9.0\n",
        "NO_ROWS": "series_id,value,date\n",
        "EMPTY": " \n\n",
        "NOTHING": "",
        "RAGGED": "date,value,series_id\n2024-01-01,1.0,RAGGED\n2024-01-02,1.0,RAGGED,9\n",
    }.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    (tmp_path / "LATIN.csv").write_bytes("date,value,series_id\n2024-01-01,1.0,é\n".encode("latin-1"))
    landed = raw_csv.land_raw_csv(spark, str(tmp_path))
    assert rows(clean_observations(landed.rows).select("series_id", "date", "value"), "value") == [
        ("PLAIN", day("2024-01-01"), 1.0), ("TURNED", day("2024-01-01"), 2.5), ("MORE", day("2024-01-01"), 3.0),
        ("MORE", day("2024-01-02"), 4.0), ("BLANK_FIRST", day("2024-01-01"), 5.0), ("TWICE", day("2024-01-01"), 6.0), (None, day("2024-01-01"), 8.0),
    ]
    assert rows(landed.rejected) == [("EMPTY", "empty_file"), ("NO_ID", "missing_column:series_id")]
    assert rows(rejected_files(landed.rows)) == [("LATIN", "malformed_line"), ("RAGGED", "malformed_line")]


def test_positions_of_late_parts_and_pieces(spark):
    """A part's pieces stay before the next part, however many there are."""
    places = [(0, 0, 0), (0, 999, 5), (0, 1_000, 5), (1, 0, 0), (250_000, 0, 0), (250_000, 999_999, 9), (2_147_483_647, 0, 0)]
    frame = spark.createDataFrame([(*p, i) for i, p in enumerate(places)], "part LONG, piece LONG, row LONG, i INT")
    part, piece = headed_csv._field(F.col("part"), 10, 28), headed_csv._field(F.col("piece"), 6, 22)
    made = frame.select("i", (part + piece + F.col("row").cast("decimal(9,0)")).cast("decimal(38,0)").alias("position"))
    assert [r["i"] for r in made.orderBy("position").collect()] == list(range(len(places)))


def test_late_part_files_are_read_in_order(spark, rows, tmp_path):
    folder = tmp_path / "series_file=S"
    folder.mkdir()
    for name, value in {"part-99999-a-c000": 1.0, "part-250000-a-c1001": 3.0, "part-250000-a-c000": 2.0}.items():
        (folder / f"{name}.csv").write_text(f"date,value,series_id\n2024-01-01,{value},S\n")
    cleaned = clean_observations(raw_csv.read_partitioned_raw_csv(spark, str(tmp_path)))
    assert [value for *_, value in rows(cleaned)] == [3.0]


def test_keep_last_holds_across_the_blocks_of_a_split_file(spark, tmp_path):
    lines = [f"2024-01-{1 + i % 28:02d},{i}.0,BIG" for i in range(60_000)]
    (tmp_path / "BIG.csv").write_text("\n".join(["date,value,series_id", *lines]) + "\n")
    (tmp_path / "SMALL.csv").write_text("date,value,series_id\n2024-01-01,1.0,S\n2024-01-01,2.0,S\n")
    changed = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "32k"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, setting in changed.items():
            spark.conf.set(key, setting)
        raw = raw_csv.read_raw_csv(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 8
        cleaned = clean_observations(raw).collect()
    finally:
        for key, setting in before.items():
            spark.conf.set(key, setting)
    last = {f"2024-01-{1 + i % 28:02d}": float(i) for i in range(60_000)}
    assert {str(r.date): r.value for r in cleaned if r.series_id == "BIG"} == last
    assert [r.value for r in cleaned if r.series_id == "S"] == [2.0]


def test_raw_csv_sink_keeps_arrival_order(spark, raw, rows, tmp_path):
    path = str(tmp_path / "out")
    many = [("F", f"2024-01-{1 + i % 5:02d}", str(float(i)), "S") for i in range(1000)]
    raw_csv.write_raw_csv(raw(many).repartitionByRange(3, "position"), path)
    cleaned = clean_observations(raw_csv.read_partitioned_raw_csv(spark, path))
    assert [value for *_, value in rows(cleaned)] == [995.0, 996.0, 997.0, 998.0, 999.0]


# Wide tables

def test_wide_csv(spark, rows, day, tmp_path):
    (tmp_path / "wide.csv").write_text(WIDE)
    long = wide_tables.read_wide_csv(spark, str(tmp_path), "BIS_OTC_DERIV")
    assert rows(long.select("series_id", "date", "value", "position")) == [
        ("X:1", day("2023-01-01"), 1.0, 0), ("X:1", day("2023-01-01"), 3.0, 2), ("X:1", day("2023-04-01"), 2.0, 1),
        ("Y:2", day("2023-01-01"), 4.0, 0), ("Y:2", day("2023-01-01"), 6.0, 2), ("Y:2", day("2023-04-01"), 5.0, 1),
    ]


def test_wide_csvs_with_other_periods_in_one_folder(spark, rows, day, tmp_path):
    for name, text in {
        "a": "Series,2023,2024\nX,1,2\n",
        "b": "2021,FREQ,Series,2020\n21,A,X,20\n22,A,Y,\n",
        "c": "Series,2019-Q4,note,202306\nX,5,6,7\n",
        "long": "Series,2018\nX,1,2\n",
        "none": "Series,note\nX,1\n",
        "unnamed": "2017,note\n1,X\n",
    }.items():
        (tmp_path / f"{name}.csv").write_text(text)
    landed = wide_tables.land_wide_csv(spark, str(tmp_path), "BIS_OTC_DERIV")
    assert rows(landed.observations.select("date", "series_id", "value")) == [
        (day("2019-10-01"), "X", 5.0), (day("2020-01-01"), "X", 20.0), (day("2021-01-01"), "X", 21.0),
        (day("2021-01-01"), "Y", 22.0), (day("2023-01-01"), "X", 1.0), (day("2024-01-01"), "X", 2.0),
    ]
    assert rows(landed.rejected) == [("long", "malformed_line"), ("none", "no_period_column"), ("unnamed", "missing_column:Series")]
    assert rows(landed.undated) == [("c", "202306")]
    gone = wide_tables.land_wide_csv(spark, str(tmp_path / "gone"), "BIS_OTC_DERIV")
    assert gone.observations.count() == 0 and rows(gone.rejected) == [(str(tmp_path / "gone"), "missing")]


def test_wide_table_drops_bad_values_and_undated_columns(spark, rows, day):
    wide = spark.createDataFrame([("X", "1.0", "n/a", "7.0")], "Series STRING, `2023` STRING, `2024` STRING, `202306` STRING")
    assert rows(wide_tables.wide_to_long(wide, "D").select("date", "value")) == [(day("2023-01-01"), 1.0)]


@pytest.mark.parametrize("columns, message", [("Series STRING, FREQ STRING", "period"), ("series STRING, `2023` STRING", "Series")])
def test_wide_table_errors(spark, columns, message):
    with pytest.raises(ValueError, match=message):
        wide_tables.wide_to_long(spark.createDataFrame([("a", "b")], columns), "D")


def test_unknown_dataset(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        wide_tables.read_wide_csv(spark, "/nowhere", "OTHER")


def _zip(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def test_archives(spark, rows, tmp_path):
    damaged = bytearray(_zip({"data.csv": WIDE * 50}))
    damaged[60] ^= 0xFF
    files = {
        "ZIPPED.zip": _zip({"readme.txt": "x", "DATA.CSV": "\ufeff" + WIDE}),
        "PLAIN.csv": ("\ufeff" + WIDE).encode(),
        "NO_CSV.zip": _zip({"readme.txt": "x"}),
        "DAMAGED.zip": bytes(damaged),
        "NOISE.zip": b"<html>",
        "RAGGED.csv": b"Series,2023\nX,1,2\n",
        "NO_ID.csv": b"Name,2023\nX,1\n",
        "NO_PERIOD.csv": b"Series,FREQ\nX,1\n",
        "SHORT.csv": b"Series,2023,2024\nX,1\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    expanded = wide_tables.expand_archives(wide_tables.read_archives(spark, str(tmp_path)))
    found = wide_tables.archive_observations(expanded).groupBy("series_file").agg(F.sum("value"))
    assert rows(found) == [("PLAIN", 21.0), ("SHORT", 1.0), ("ZIPPED", 21.0)]
    rejected = {name for name, _ in rows(wide_tables.rejected_archives(expanded))}
    assert rejected == {"NO_CSV", "DAMAGED", "NOISE", "RAGGED", "NO_ID", "NO_PERIOD"}


def test_archives_by_their_directories(spark, rows, day, tmp_path):
    damaged = bytearray(_zip({"data.csv": WIDE * 50}))
    damaged[60] ^= 0xFF
    files = {
        "ZIPPED.zip": _zip({"readme.txt": "x", "DATA.CSV": "\ufeff" + WIDE, "more.csv": "Series,2020\nZ,9\n"}),
        "PLAIN.csv": ("\ufeff" + WIDE).encode(),
        "NO_CSV.zip": _zip({"readme.txt": "x"}),
        "DAMAGED.zip": bytes(damaged),
        "CUT.zip": _zip({"data.csv": WIDE})[:-30],
        "NOISE.zip": b"<html>",
        "EMPTY.csv": b"",
        "LATIN.csv": "Series,2023\né,1\n".encode("latin-1"),
        "RAGGED.csv": b"Series,2023\nX,1,2\n",
        "NO_ID.csv": b"Name,2023\nX,1\n",
        "NO_PERIOD.csv": b"Series,FREQ\nX,1\n",
        "SHORT.csv": b"Series,2023,202301\n\nX,1\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    landed = wide_tables.land_archives(spark, str(tmp_path))
    found = landed.observations.groupBy("series_file").agg(F.sum("value"))
    assert rows(found) == [("PLAIN", 21.0), ("SHORT", 1.0), ("ZIPPED", 21.0)]
    reasons = dict(rows(landed.rejected))
    assert sorted(reasons) == sorted(set(n.split(".")[0] for n in files) - {"ZIPPED", "PLAIN", "SHORT"})
    assert (reasons["RAGGED"], reasons["EMPTY"], reasons["NO_CSV"]) == ("malformed_line", "empty_file", "no CSV in the archive")
    assert rows(landed.undated) == [("SHORT", "202301")]
    every = wide_tables.land_archives(spark, str(tmp_path / "ZIPPED.zip"), members="all")
    assert rows(every.observations.groupBy("series_file").agg(F.sum("value"))) == [("ZIPPED", 30.0)]
    gone = wide_tables.land_archives(spark, str(tmp_path / "gone"))
    assert gone.observations.count() == 0 and rows(gone.rejected) == [(str(tmp_path / "gone"), "missing")]


class _Holes:
    """A file that leaves holes where zeros are written."""

    def __init__(self, file):
        self._file = file

    def write(self, data):
        if bytes(data).strip(b"\0"):
            return self._file.write(data)
        self._file.seek(len(data), 1)
        return len(data)

    def __getattr__(self, name):
        return getattr(self._file, name)


def test_an_archive_beyond_two_gigabytes(spark, rows, day, tmp_path):
    path = tmp_path / "BIG.zip"
    zeros = bytes(16 << 20)
    with open(path, "wb") as file, zipfile.ZipFile(_Holes(file), "w") as archive:
        with archive.open("pad.bin", "w", force_zip64=True) as member:
            for _ in range(136):
                member.write(zeros)
        for i in range(3):
            archive.writestr(zipfile.ZipInfo(f"{i}.csv"), f"Series,202{i}\nX,{i}.5\n", zipfile.ZIP_DEFLATED)
    assert path.stat().st_size > 2**31 > path.stat().st_blocks * 512
    parts = archives.ArchiveReader(str(tmp_path), False, "all").partitions()
    assert [p.member for p in parts] == ["0.csv", "1.csv", "2.csv"]
    landed = wide_tables.land_archives(spark, str(tmp_path), members="all")
    assert rows(landed.observations.select("date", "value")) == [
        (day("2020-01-01"), 0.5), (day("2021-01-01"), 1.5), (day("2022-01-01"), 2.5),
    ]


def test_a_long_member_is_streamed(tmp_path):
    import tracemalloc

    path = tmp_path / "D.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("d.csv", "w") as member:
        member.write(b"Series,2023\n")
        for i in range(150):
            member.write(b"X%d,%s\n" % (i, b"1.5" * 1000) * 100)
    reader = archives.ArchiveReader(str(path), False, "first")
    tracemalloc.start()
    lines = sum(batch.num_rows for batch in reader.read(reader.partitions()[0]))
    # 45 MB of cells pass through.
    assert lines == 15_000 and tracemalloc.get_traced_memory()[1] < 25 << 20
    tracemalloc.stop()


def test_a_cell_beyond_the_limit_rejects_its_file(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "CELL_LIMIT", 1000)
    (tmp_path / "A.csv").write_text("Series,2023\n" + "x" * 2000 + ",1\n")
    reader = archives.ArchiveReader(str(tmp_path), False, "first")
    found = [r for b in reader.read(reader.partitions()[0]) for r in b.to_pylist()]
    assert len(found) == 1 and "field larger" in found[0]["reason"]


def test_headings_without_a_day_are_listed(spark, rows):
    content = b"Series,2023,202306,2023-13,FREQ\nX,1,2,3,4\nY,1,2,3,4\n"
    archives = spark.createDataFrame([("D", bytearray(content))], "series_file STRING, content BINARY")
    expanded = wide_tables.expand_archives(archives)
    assert rows(wide_tables.undated_periods(expanded)) == [("D", "2023-13"), ("D", "202306")]
    assert wide_tables.archive_observations(expanded).count() == 2


def test_last_of_several_headings_for_a_day_wins(spark, rows, day, tmp_path):
    (tmp_path / "BIS_OTC_DERIV.zip").write_bytes(_zip({"data.csv": WIDE}))
    expanded = wide_tables.expand_archives(wide_tables.read_archives(spark, str(tmp_path)))
    from rateflow.plans.clean import deduplicated

    assert rows(deduplicated(wide_tables.archive_observations(expanded)).drop("series_file")) == [
        ("X:1", day("2023-01-01"), 3.0), ("X:1", day("2023-04-01"), 2.0),
        ("Y:2", day("2023-01-01"), 6.0), ("Y:2", day("2023-04-01"), 5.0),
    ]


# Observation files

def test_observation_files_and_selection(spark, observations, rows, day, tmp_path):
    path = str(tmp_path / "obs")
    written = observations([
        ("DGS10", "DGS10", "2014-12-31", 1.0), ("DGS10", "DGS10", "2024-01-01", 2.0),
        ("DGS2", "DGS2", "2024-01-02", float("nan")), ("other", "other", "2024-01-01", 3.0),
    ])
    tables.write_observations(written, path)
    read = tables.read_observations(spark, path)
    assert ("DGS2", "DGS2", day("2024-01-02"), None) in rows(read)
    assert rows(tables.select_observations(read, ["DGS10"])) == [("DGS10", "DGS10", day("2024-01-01"), 2.0)]
    assert tables.select_observations(read, start_date="2014-01-01").count() == 3
    assert tables.select_observations(read, ["DGS10"], "2014-01-01", "2015-01-01").count() == 1
    with pytest.raises(ValueError, match="unknown series"):
        tables.select_observations(read, ["NOPE"])


def test_series_and_date_filters_reach_the_scan(spark, observations, tmp_path):
    path = str(tmp_path / "obs")
    tables.write_observations(observations([("DGS10", "DGS10", "2024-01-01", 2.0)]), path)
    chosen = tables.select_observations(tables.read_observations(spark, path), ["DGS10"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(series_id,DGS10)" in plan or "In(series_id" in plan
    assert "GreaterThanOrEqual(date,2015-01" in plan
