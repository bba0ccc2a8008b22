"""Zip archives as Spark data sources: one partition per member, read by byte ranges.

``spark.read.format("zip_records")`` gives the records of the members of every
archive below a folder; ``"zip_member_text"`` gives one member of each archive
as text.  Planning lists the archives and reads their central directories (the
last kilobytes of each); a task then reads its own member's byte range and
inflates it as a stream.  No archive is ever held whole, its size has no limit,
and an archive of many members is read by many tasks.

Storage is reached through ``pyarrow.fs`` (local and mounted folders, HDFS, S3,
GCS by URI), because a task needs to seek.
"""

from __future__ import annotations

import io
import os
import zipfile
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Errors that mean the archive or member itself is damaged, as opposed to storage that fails.
DAMAGED = (zipfile.BadZipFile, NotImplementedError, EOFError, UnicodeDecodeError, OverflowError, ValueError, zlib.error)
#: Records of a batch handed to Spark, and central directories read at once while planning.
BATCH, PLANNERS = 10_000, 16


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a URI or a plain path."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and "://" not in path else path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def archives(path: str, suffix: str = ".zip") -> list[str]:
    """The archives at or below ``path``, as paths that ``locate`` understands, without hidden and empty files."""
    fs, root = locate(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
    prefix = "" if isinstance(fs, pafs.LocalFileSystem) else path.partition("://")[0] + "://"
    hidden = lambda p: any(x.startswith((".", "_")) for x in p[len(root):].split("/"))
    return sorted(prefix + f.path for f in found if f.type == pafs.FileType.File and f.size and f.path.endswith(suffix) and not hidden(f.path))


class Opened:
    """An archive open for seeking; only its central directory is read until a member is."""

    def __init__(self, path: str):
        fs, name = locate(path)
        self.raw = fs.open_input_file(name)
        try:
            self.zip = zipfile.ZipFile(self.raw)
        except BaseException:
            self.raw.close()
            raise

    def __enter__(self) -> zipfile.ZipFile:
        return self.zip

    def __exit__(self, *_) -> None:
        self.zip.close()
        self.raw.close()


@dataclass
class Member(InputPartition):
    """A member to read, or the reason why the archive has none."""
    path: str
    member: str | None
    size: int = 0
    reason: str | None = None

    def __post_init__(self):
        super().__init__(None)


def plan(paths: list[str], wanted: Callable[[str], bool], tolerant: bool, first_only: bool = False) -> list[Member]:
    """The members to read, largest first, so that a long one does not begin last; a damaged archive is one row when ``tolerant``."""
    def of(path: str) -> list[Member]:
        try:
            with Opened(path) as z:
                got = [Member(path, i.filename, i.file_size) for i in z.infolist() if not i.is_dir() and wanted(i.filename)]
        except DAMAGED as e:
            if not tolerant:
                raise
            return [Member(path, None, 0, f"not readable: {e}")]
        if first_only:
            return got[:1] or [Member(path, None)]
        return got

    with ThreadPoolExecutor(PLANNERS) as pool:
        return sorted((m for found in pool.map(of, paths) for m in found), key=lambda m: -m.size)


def records(text_stream: io.TextIOBase) -> Iterator[str]:
    """Split CSV text into records; a newline inside quotes stays in the record."""
    held: list[str] = []
    quotes = 0
    for line in text_stream:
        held.append(line)
        quotes += line.count('"')
        if quotes % 2 == 0:
            yield "".join(held).rstrip("\r\n")
            held, quotes = [], 0
    if held:
        yield "".join(held).rstrip("\r\n")


RECORDS = pa.schema([("path", pa.string()), ("member", pa.string()), ("record_no", pa.int64()), ("record", pa.string())])
TEXTS = pa.schema([("path", pa.string()), ("member", pa.string()), ("text", pa.string())])


class ZipRecords(DataSource):
    """Records of the members of zip archives: path, member, record_no (from 1, the header left out), record.

    Options: ``path``; ``suffix`` of the members (default ``.csv``) and
    ``ignoreCase`` (default true); ``tolerant`` (default false): an archive that
    cannot be opened, or a member that breaks off, gives a row without
    record_no whose record is the reason, instead of failing the job.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_records"

    def schema(self) -> str:
        return "path string, member string, record_no bigint, record string"

    def reader(self, schema) -> DataSourceReader:
        return _RecordReader(dict(self.options))


class _RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        low = {k.lower(): v for k, v in options.items()}
        self.root, self.suffix = low["path"], low.get("suffix", ".csv")
        self.ignore_case, self.tolerant = low.get("ignorecase", "true") == "true", low.get("tolerant", "false") == "true"

    def wanted(self, name: str) -> bool:
        return name.lower().endswith(self.suffix.lower()) if self.ignore_case else name.endswith(self.suffix)

    def partitions(self) -> list[Member]:
        return plan(archives(self.root), self.wanted, self.tolerant) or [Member("", None)]

    def read(self, part: Member) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([part.path] * len(rows)), pa.array([part.member] * len(rows), pa.string()),
                                               pa.array([n for n, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.string())], schema=RECORDS)

        if part.reason is not None:
            yield batch([(None, part.reason)])
        if part.member is None:
            return
        held: list[tuple[int | None, str]] = []
        try:
            with Opened(part.path) as z, z.open(part.member) as f:
                for i, r in enumerate(records(io.TextIOWrapper(f, encoding="utf-8", newline=""))):
                    if i:  # the header of every member is left out
                        held.append((i, r))
                    if len(held) >= BATCH:
                        yield batch(held)
                        held = []
        except DAMAGED as e:
            if not self.tolerant:
                raise
            held.append((None, f"not readable: {e}"))
        if held:
            yield batch(held)


class ZipMemberText(DataSource):
    """One row per zip archive: path, member, text of the first member whose name contains ``contains``.

    An archive without such a member, or one that cannot be read, has null
    member and text.  Only the central directory and that member are read.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_member_text"

    def schema(self) -> str:
        return "path string, member string, text string"

    def reader(self, schema) -> DataSourceReader:
        return _TextReader(dict(self.options))


class _TextReader(DataSourceReader):
    def __init__(self, options: dict):
        low = {k.lower(): v for k, v in options.items()}
        self.root, self.contains = low["path"], low["contains"]
        self.per_task = max(1, int(low.get("archivespertask", "32")))

    def partitions(self) -> list[InputPartition]:
        # the directories are read by the tasks, a group of archives each: planning only lists
        found = archives(self.root)
        return [InputPartition(found[i:i + self.per_task]) for i in range(0, len(found), self.per_task)] or [InputPartition([])]

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        for path in part.value:
            member = text = None
            try:
                m = plan([path], lambda n: self.contains in n, True, first_only=True)[0]
                if m.member is not None:
                    member = m.member
                    with Opened(path) as z, z.open(member) as f:
                        text = f.read().decode("utf-8", "replace")
            except DAMAGED:
                pass
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([member], pa.string()), pa.array([text], pa.string())], schema=TEXTS)


def register(spark: SparkSession) -> None:
    """Make both formats known to the session."""
    spark.dataSource.register(ZipRecords)
    spark.dataSource.register(ZipMemberText)
