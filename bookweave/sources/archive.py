"""Daily archives: gzip-compressed tar files of JSON lines, read as a Spark data source.

Each archive is one partition and is streamed: every regular, non-empty entry in tar order, line by
line. ``seq`` numbers the lines of the whole archive. A file that is empty, cut off or no tar gives
one row with ``error`` instead of lines after the point of failure.
"""

from __future__ import annotations

import gzip
import tarfile
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SUFFIX = ".tar.gz"
BROKEN = (tarfile.TarError, EOFError, OSError, zlib.error, gzip.BadGzipFile)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


def find(path: str, suffix: str) -> list[str]:
    """Files below path that end in suffix, in order; path may be a file itself."""
    fs, root = filesystem(path)
    scheme = path[: len(path) - len(root)] if path.endswith(root) else ""
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        return []
    files = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted(scheme + f.path for f in files if f.type == pafs.FileType.File and f.path.endswith(suffix))


def usage(root: str) -> int:
    """Bytes of the archives below root and of those still being written."""
    fs, inner = filesystem(root)
    if fs.get_file_info(inner).type == pafs.FileType.NotFound:
        return 0
    files = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    return sum(f.size or 0 for f in files if f.type == pafs.FileType.File and f.path.endswith((SUFFIX, ".tmp")))


def entries(path: str) -> Iterator[Iterator[bytes]]:
    """The lines of each regular non-empty entry; raises what BROKEN names."""
    fs, inner = filesystem(path)
    if fs.get_file_info(inner).size == 0:
        raise tarfile.ReadError("archive is empty")
    with fs.open_input_stream(inner, compression=None) as raw, gzip.GzipFile(fileobj=raw) as packed:
        with tarfile.open(fileobj=packed, mode="r|") as tar:
            found = False
            for entry in tar:
                found = True
                if entry.isreg() and entry.size:
                    yield iter(tar.extractfile(entry))
            if not found:
                raise tarfile.ReadError("archive has no entries")
        while packed.read(1 << 20):  # the checksum stands at the very end
            pass


def day_of(path: str) -> tuple[str, str]:
    """(symbol, date) of <symbol>/<YYYY-MM-DD>.tar.gz."""
    p = PurePosixPath(path)
    return p.parent.name, p.name.removesuffix(SUFFIX)


def valid(path: str) -> str | None:
    """What is wrong with an archive, or None; reads it to the end."""
    try:
        for lines in entries(path):
            for _ in lines:
                pass
    except BROKEN as e:
        return str(e) or type(e).__name__
    return None


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[Archive]:
        return [Archive(p) for path in self.paths for p in find(path, SUFFIX)]

    def read(self, partition: Archive) -> Iterator[tuple]:
        symbol, date = day_of(partition.path)
        seq = 0
        try:
            for n, lines in enumerate(entries(partition.path)):
                for raw in lines:
                    seq += 1
                    raw = raw.removesuffix(b"\n").removesuffix(b"\r")
                    try:
                        line = raw.decode()
                    except UnicodeDecodeError:
                        continue  # an unreadable line is not counted
                    if line:
                        yield symbol, date, n, seq, line, None
        except BROKEN as e:
            yield symbol, date, None, seq + 1, None, str(e) or type(e).__name__


class ArchiveSource(DataSource):
    """spark.read.format("book_archive").load(path): an archive, a folder of them, or several of either, one a line"""

    @classmethod
    def name(cls) -> str:
        return "book_archive"

    def schema(self) -> str:
        return "symbol string, trade_date string, entry int, seq long, line string, error string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"].split("\n"))


def read_archives(spark: SparkSession, *paths: str) -> DataFrame:
    """The lines of all archives at or below paths."""
    spark.dataSource.register(ArchiveSource)
    lines = spark.read.format("book_archive").load("\n".join(paths))
    return lines.withColumn("trade_date", lines["trade_date"].cast("date"))
