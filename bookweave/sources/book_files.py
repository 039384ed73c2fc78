"""Single-file books and blobs: one Parquet file or one blob for each (symbol, day), and batches of them on executors."""

from __future__ import annotations

import io
import posixpath
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.operators import delta_blob
from bookweave.operators.replay import DAY, book_columns
from bookweave.sources.archive import filesystem, find

PARQUET, BLOB = ".parquet", ".okxd.zst"
RESULT = "input string, output string, rows long, depth int, scale long, status string, error string"


def day_path(root: str, symbol: str, trade_date: object, suffix: str) -> str:
    """<root>/<symbol>/<YYYY-MM-DD><suffix>."""
    return posixpath.join(root, symbol, f"{trade_date}{suffix}")


def publish(path: str, data: bytes | BinaryIO, size: int | None = None) -> None:
    """Writes beside the path and renames, so that readers see whole files only. A stream goes piece by piece; size: how many bytes it must have."""
    fs, inner = filesystem(path)
    fs.create_dir(posixpath.dirname(inner), recursive=True)
    source, written = io.BytesIO(data) if isinstance(data, bytes) else data, 0
    try:
        with fs.open_output_stream(inner + ".tmp", compression=None) as f:
            while piece := source.read(1 << 20):
                written += f.write(piece)
        if size is not None and written != size:
            raise OSError(f"got {written} of {size} bytes")
        fs.move(inner + ".tmp", inner)
    finally:
        if fs.get_file_info(inner + ".tmp").type != pa.fs.FileType.NotFound:
            fs.delete_file(inner + ".tmp")


def parquet_bytes(table: pa.Table, rows: int = 10_000) -> bytes:
    sink = pa.BufferOutputStream()
    pq.write_table(table, sink, compression="snappy", row_group_size=rows)
    return sink.getvalue().to_pybytes()


def read_bytes(path: str) -> bytes:
    fs, inner = filesystem(path)
    with fs.open_input_stream(inner, compression=None) as f:
        return f.read()


def read_book(path: str) -> pa.Table:
    return pq.read_table(pa.BufferReader(read_bytes(path)))


def write_days(books: DataFrame, root: str) -> DataFrame:
    """One Parquet file for each day of sampled books (symbol, trade_date, timestamp_ms, columns), in any order; returns path and rows."""
    return write_sorted_days(books.repartition(*DAY).sortWithinPartitions(*DAY, "timestamp_ms"), root)


def write_sorted_days(books: DataFrame, root: str, batch: int = 10_000) -> DataFrame:
    """As write_days, where each day already stands whole in one partition, in order of time, as ``fused.ladders`` leaves it.

    Rows go to the file in row groups of ``batch``, so memory does not follow the day's length. A file shows under its name
    once it is complete and its own count agrees with the rows; times that do not ascend are an error.
    """
    schema = pa.schema([pa.field("timestamp_ms", pa.int64(), nullable=False), *(pa.field(c, pa.float32()) for c in book_columns())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        day, file, done = None, None, []
        for part in batches:
            keys = pa.StructArray.from_arrays([part.column(0), part.column(1)], names=DAY)
            ends = [0, *(i for i in range(1, part.num_rows) if keys[i] != keys[i - 1]), part.num_rows] if part.num_rows and keys[0] != keys[-1] else [0, part.num_rows]
            for a, b in zip(ends, ends[1:], strict=False):
                if a == b:
                    continue
                key = tuple(keys[a].as_py().values())
                if key != day:
                    done += [file.close()] if file else []
                    day, file = key, DayFile(day_path(root, *key, PARQUET), schema, batch)
                file.add(part.slice(a, b - a).select(schema.names))
        done += [file.close()] if file else []
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("rows", pa.int64())]))

    return books.select(*DAY, *schema.names).mapInArrow(write, "path string, rows long")


class DayFile:
    """A Parquet file that grows by row groups and is renamed when it is whole."""

    def __init__(self, path: str, schema: pa.Schema, batch: int):
        self.path, self.schema, self.batch = path, schema, batch
        self.fs, self.inner = filesystem(path)
        self.fs.create_dir(posixpath.dirname(self.inner), recursive=True)
        self.writer = pq.ParquetWriter(self.inner + ".tmp", schema, filesystem=self.fs, compression="snappy")
        self.held, self.waiting, self.rows, self.last = [], 0, 0, None

    def add(self, part: pa.RecordBatch) -> None:
        times = part.column("timestamp_ms").to_numpy()
        if (times[1:] <= times[:-1]).any() or (self.last is not None and times[0] <= self.last):
            raise ValueError(f"times of {self.path} do not ascend")
        self.last = times[-1]
        self.held.append(part)
        self.waiting += part.num_rows
        if self.waiting >= self.batch:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.writer.write_table(pa.Table.from_batches(self.held).cast(self.schema), row_group_size=self.batch)
        self.rows += self.waiting
        self.held, self.waiting = [], 0

    def close(self) -> dict:
        self.flush()
        self.writer.close()
        with self.fs.open_input_file(self.inner + ".tmp") as f:
            found = pq.read_metadata(f).num_rows
        if found != self.rows or not found:
            self.fs.delete_file(self.inner + ".tmp")
            raise ValueError(f"{self.path} has {found} rows, not {self.rows}")
        self.fs.move(self.inner + ".tmp", self.inner)
        return {"path": self.path, "rows": found}


def _each(spark: SparkSession, pairs: list[tuple[str, str]], work: Callable[[str, str], dict]) -> DataFrame:
    """Runs work(input, output) for each pair, one file for each task; an error becomes a row."""
    schema = pa.schema([("input", pa.string()), ("output", pa.string()), ("rows", pa.int64()), ("depth", pa.int32()), ("scale", pa.int64()), ("status", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    row |= {"status": "done"} | work(row["input"], row["output"])
                except (ValueError, OSError) as e:
                    row |= {"status": "failed", "error": str(e)}
                yield pa.RecordBatch.from_pylist([row], schema)

    files = spark.createDataFrame(pairs, "input string, output string")
    return files.repartition(max(1, len(pairs))).mapInArrow(run, RESULT)


def encode_tree(spark: SparkSession, root: str, out: str, scale: int = delta_blob.SCALE, level: int = 19, verify: bool = False, skip_existing: bool = True, dry_run: bool = False) -> DataFrame:
    """Codes every book below root to a blob at the same place below out; non-empty blobs are left as they are. dry_run only says what would be done."""
    delta_blob.compress(b"", level)
    pairs = [(p, _moved(p, root, out, PARQUET, BLOB)) for p in find(root, PARQUET)]

    def work(source: str, target: str) -> dict:
        if skip_existing and _size(target):
            return {"status": "skipped"} | delta_blob.inspect(read_bytes(target))
        if dry_run:
            return {"status": "planned"}
        table = read_book(source)
        packed = delta_blob.encode(table, scale, level)
        if verify and delta_blob.same_bits(table, delta_blob.decode(packed)):
            raise ValueError("decoded book differs")
        publish(target, packed)
        return delta_blob.inspect(packed)

    return _each(spark, pairs, work)


def decode_tree(spark: SparkSession, root: str, out: str, skip_existing: bool = True, dry_run: bool = False) -> DataFrame:
    """Decodes every blob below root to a Parquet file below out."""
    pairs = [(p, _moved(p, root, out, BLOB, PARQUET)) for p in find(root, BLOB)]

    def work(source: str, target: str) -> dict:
        packed = read_bytes(source)
        if skip_existing and _size(target):
            return {"status": "skipped"} | delta_blob.inspect(packed)
        if dry_run:
            return {"status": "planned"} | delta_blob.inspect(packed)
        publish(target, parquet_bytes(delta_blob.decode(packed)))
        return delta_blob.inspect(packed)

    return _each(spark, pairs, work)


def verify_tree(spark: SparkSession, books: str, blobs: str) -> DataFrame:
    """Compares every blob below blobs with its book, bit by bit."""
    pairs = [(_moved(p, blobs, books, BLOB, PARQUET), p) for p in find(blobs, BLOB)]

    def work(book: str, blob: str) -> dict:
        packed = read_bytes(blob)
        cells = delta_blob.same_bits(read_book(book), delta_blob.decode(packed))
        return delta_blob.inspect(packed) | ({"status": "failed", "error": f"{cells} cells differ"} if cells else {})

    return _each(spark, pairs, work)


def scan_headers(spark: SparkSession, root: str) -> DataFrame:
    """rows, depth and scale of every blob below root, from as many of its bytes as the header can need."""
    pairs = [(p, "") for p in find(root, BLOB)]

    def work(source: str, target: str) -> dict:
        fs, inner = filesystem(source)
        with fs.open_input_stream(inner, compression=None) as f:
            return delta_blob.inspect(f)

    return _each(spark, pairs, work)


def copy_tree(spark: SparkSession, root: str, out: str, suffix: str = "") -> DataFrame:
    """Copies the files below root that end in suffix to the same places below out, on any file systems, one file for each task; files of equal size are left as they are."""
    pairs = [(p, _moved(p, root, out, "", "")) for p in find(root, suffix)]

    def work(source: str, target: str) -> dict:
        if _size(target) == _size(source):
            return {"status": "skipped"}
        fs, inner = filesystem(source)
        with fs.open_input_stream(inner, compression=None) as f:
            publish(target, f, _size(source))
        return {}

    return _each(spark, pairs, work)


def scan_blobs(spark: SparkSession, root: str) -> DataFrame:
    """All blobs below root as one table of sampled books."""
    names = book_columns()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for part in delta_blob.batches_of(delta_blob.decode(read_bytes(path))):
                    yield pa.RecordBatch.from_arrays([pa.array([path] * part.num_rows), *part.columns], names=["path", *part.schema.names])

    files = spark.createDataFrame([(p,) for p in find(root, BLOB)], "path string")
    return files.repartition(max(1, files.count())).mapInArrow(rows, "path string, timestamp_ms long, " + ", ".join(f"{n} float" for n in names))


def path_column() -> Column:
    """The path of a row's file as it is written; Spark gives it with blanks and other signs encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def scan_books(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet books below root, with symbol and trade_date from their paths; columns are pruned and filters reach the files."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{PARQUET}").parquet(root)
    path = F.split(path_column(), "/")
    return rows.select("*", F.element_at(path, -2).alias("symbol"), F.substring(F.element_at(path, -1), 1, 10).cast("date").alias("trade_date"))


def _moved(path: str, root: str, out: str, old: str, new: str) -> str:
    return posixpath.join(out, path.removeprefix(root).lstrip("/").removesuffix(old) + new)


def _size(path: str) -> int:
    fs, inner = filesystem(path)
    info = fs.get_file_info(inner)
    return info.size or 0 if info.type == pa.fs.FileType.File else 0
