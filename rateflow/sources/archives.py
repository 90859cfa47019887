"""CSVs in ZIP archives of any size, as a data source.

    spark.dataSource.register(ArchiveTables)
    spark.read.format("archive_tables").option("headings", "true").load(folder)

Planning reads each archive's directory, which is at its end, and makes a
partition of each CSV in it; a task seeks to its member and streams it. Neither
the archive nor a member is ever held whole. A file that is no archive is one
plain CSV. What cannot be read comes out as a row with a ``reason``.

Paths are those of ``pyarrow.fs`` (local and shared folders, S3, GCS, HDFS).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "archive_tables"
LINES = "file STRING, series_file STRING, line LONG, cells ARRAY<STRING>, reason STRING"
#: A longer cell rejects its file.
CELL_LIMIT = 16 << 20
_BATCH_LINES, _BATCH_BYTES = 2000, 8 << 20


def read_archive_lines(
    spark: SparkSession, path: str, headings: bool = False, members: str = "first"
) -> DataFrame:
    """``(file, series_file, line, cells, reason)`` of the CSVs in the archives
    under ``path``: their first lines (``headings``) or all others.

    ``members`` is the ``first`` CSV of each archive, or ``all``; each is a
    ``file`` of its own. A missing path has no files.
    """
    spark.dataSource.register(ArchiveTables)
    return (
        spark.read.format(FORMAT)
        .option("headings", str(headings).lower())
        .option("members", members)
        .load(path)
    )


class ArchiveTables(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> "ArchiveReader":
        return ArchiveReader(
            self.options["path"],
            self.options.get("headings", "false") == "true",
            self.options.get("members", "first"),
        )


@dataclass
class Member(InputPartition):
    """A CSV: a member of an archive, or (``member`` None) a whole file."""

    uri: str
    file: str
    series_file: str
    member: str | None = None
    reason: str | None = None


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, headings: bool, members: str) -> None:
        if members not in ("first", "all"):
            raise ValueError(f"members is first or all, not {members!r}")
        self.path, self.headings, self.members = path, headings, members

    def partitions(self) -> list[Member]:
        import pyarrow.fs as pafs

        store, root = pafs.FileSystem.from_uri(self.path)
        info = store.get_file_info(root)
        if info.type == pafs.FileType.Directory:
            found = store.get_file_info(pafs.FileSelector(root, recursive=True))
        else:
            found = [info] if info.type == pafs.FileType.File else []
        files = sorted(f.path for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._")
        with ThreadPoolExecutor(16) as pool:
            return [member for each in pool.map(lambda f: self._members(store, f), files) for member in each]

    def _members(self, store, path: str) -> list[Member]:
        import os
        import zipfile

        stem = os.path.splitext(os.path.basename(path))[0]
        try:
            with store.open_input_file(path) as file:
                if file.read_at(2, 0) != b"PK":
                    return [Member(self.path, path, stem)]
                with zipfile.ZipFile(file) as archive:
                    names = [n for n in archive.namelist() if n.lower().endswith(".csv")]
        except (OSError, ValueError, RuntimeError, zipfile.BadZipFile) as error:
            return [Member(self.path, path, stem, reason=f"unreadable: {error}")]
        if not names:
            return [Member(self.path, path, stem, reason="no CSV in the archive")]
        kept = names if self.members == "all" else names[:1]
        return [Member(self.path, f"{path}!{name}", stem, name) for name in kept]

    def read(self, partition: Member | None) -> Iterator:
        import csv
        import zipfile
        import zlib

        import pyarrow as pa

        schema = pa.schema([
            ("file", pa.string()), ("series_file", pa.string()), ("line", pa.int64()),
            ("cells", pa.list_(pa.string())), ("reason", pa.string()),
        ])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 3
            n = len(rows)
            return pa.record_batch(
                [
                    pa.array([partition.file] * n, pa.string()),
                    pa.array([partition.series_file] * n, pa.string()),
                    *(pa.array(c, t.type) for c, t in zip(columns, list(schema)[2:])),
                ],
                schema=schema,
            )

        if partition is None:  # no partitions at all
            return
        if partition.reason is not None:
            yield batch([(0, None, partition.reason)])
            return
        unreadable = (ValueError, EOFError, OSError, RuntimeError, csv.Error, zipfile.BadZipFile, zlib.error)
        rows, held, number = [], 0, -1
        try:
            for number, cells in enumerate(_lines(partition)):
                if self.headings:
                    yield batch([(number, cells, None)])
                    return
                if number:
                    rows.append((number, cells, None))
                    held += sum(map(len, cells))
                if len(rows) >= _BATCH_LINES or held >= _BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
            if number < 0:
                raise ValueError("empty_file")
        except unreadable as error:
            rows.append((number + 1, None, str(error) or type(error).__name__))
        if rows:
            yield batch(rows)


def _lines(partition: Member) -> Iterator[list[str]]:
    """The CSV's lines that are not blank, streamed."""
    import csv
    import io
    import zipfile

    import pyarrow.fs as pafs

    store, _ = pafs.FileSystem.from_uri(partition.uri)
    csv.field_size_limit(CELL_LIMIT)
    path = partition.file
    if partition.member is not None:
        path = path[: -len(partition.member) - 1]
    with store.open_input_file(path) as file:
        if partition.member is None:
            stream = io.TextIOWrapper(_Chunks(file), "utf-8-sig", newline="")
            yield from filter(None, csv.reader(stream))
            return
        with zipfile.ZipFile(file) as archive, archive.open(partition.member) as member:
            yield from filter(None, csv.reader(io.TextIOWrapper(member, "utf-8-sig", newline="")))


class _Chunks:
    """What a text reader asks of a binary file, over one that cannot ``read1``."""

    def __init__(self, file) -> None:
        self._file = file
        self.closed = False

    def read1(self, size: int = -1) -> bytes:
        return self._file.read(size if size > 0 else 1 << 20)

    read = read1

    def readable(self) -> bool:
        return True

    def writable(self) -> bool:
        return False

    def seekable(self) -> bool:
        return False

    def flush(self) -> None:
        pass

    def close(self) -> None:
        self.closed = True
