"""Ledger states as JSON files: one for each day, with older files of one for each symbol still read."""

from __future__ import annotations

import json
import os
import posixpath
import time
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.operators.ledger import DAY_STATE, TASK, from_legacy, normalized
from bookweave.session import hadoop_file
from bookweave.sources.archive import filesystem, find
from bookweave.sources.book_files import path_column, publish

LOCK = ".lock"
LEGACY = "map<string,struct<downloaded:boolean,not_available:boolean,processed:boolean,validated:boolean,raw_deleted:boolean,download_attempts:bigint,rows:bigint>>"
FIELDS = [f.split()[0] for f in DAY_STATE.split(", ")]
#: Fields that a state without a file has.
EMPTY = {"download": "pending", "process": "pending", "download_attempts": 0, "process_attempts": 0, "raw_deleted": False}


def ledger_path(root: str, symbol: str, trade_date: object) -> str:
    return posixpath.join(root, symbol, f"{trade_date}.json")


def _texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths, wholetext=True).select(F.split(path_column(), "/").alias("at"), F.col("value"))


def read_states(spark: SparkSession, root: str, tasks: DataFrame) -> DataFrame:
    """tasks: TASK. Their states: from the day's file, else the symbol's older file, else the default. Unreadable files count as missing."""
    files = find(root, ".json")
    depth = root.rstrip("/").count("/") + 1
    days, old = [f for f in files if f.count("/") > depth], [f for f in files if f.count("/") == depth]
    states = legacy = None
    if days:
        rows = _texts(spark, days).select(F.element_at("at", -2).alias("symbol"), F.to_date(F.substring(F.element_at("at", -1), 1, 10)).alias("trade_date"), F.from_json("value", DAY_STATE).alias("s"))
        states = rows.select(*TASK, "s.*")
    if old:
        rows = _texts(spark, old).select(F.regexp_replace(F.element_at("at", -1), r"\.json$", "").alias("symbol"), F.explode(F.from_json("value", LEGACY)).alias("day", "s"))
        legacy = from_legacy(rows.select("symbol", F.expr("try_to_date(day, 'yyyy-MM-dd')").alias("trade_date"), "s.*"))
    found = tasks.select(*TASK).distinct()
    for n, known in enumerate(x for x in (states, legacy) if x is not None):
        known = known.select(*TASK, F.struct(*(c for c in FIELDS if c in known.columns)).alias(f"_{n}"))
        found = found.join(known, TASK, "left")
    layers = [c for c in found.columns if c.startswith("_")]
    value = lambda f: F.coalesce(*(F.col(f"{c}.{f}") for c in layers if f in found.schema[c].dataType.names), F.lit(EMPTY.get(f)))
    kept = ("download", "process", "download_attempts", "process_attempts", "rows", "raw_deleted", "last_error", "updated_at")
    types = dict(f.split() for f in DAY_STATE.split(", "))
    return normalized(found.select(*TASK, *((value(f) if layers else F.lit(EMPTY.get(f))).cast(types[f].replace("long", "bigint")).alias(f) for f in kept)))


def write_states(states: DataFrame, root: str) -> int:
    """One file for each state, written whole; returns how many."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    rows = states.withColumn("updated_at", now).select(*TASK, F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"}).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                publish(ledger_path(root, row["symbol"], row["trade_date"]), json.dumps(json.loads(row["text"]), indent=2).encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


@contextmanager
def locked(spark: SparkSession, root: str, wait_s: float = 120, stale_s: float = 900) -> Iterator[None]:
    """Holds the ledger's lock file, so that of several runs one at a time reads and writes states; a lock older than stale_s was left by a run that died."""
    fs, inner = filesystem(root)
    fs.create_dir(inner, recursive=True)
    path, local = posixpath.join(root, LOCK), isinstance(fs, pa.fs.LocalFileSystem)
    until = time.monotonic() + wait_s
    while True:
        try:
            if local:
                os.close(os.open(posixpath.join(inner, LOCK), os.O_CREAT | os.O_EXCL))
            else:
                hadoop, at = hadoop_file(spark, path)
                hadoop.create(at, False).close()
            break
        except (OSError, Py4JJavaError):
            info = fs.get_file_info(posixpath.join(inner, LOCK))
            if info.type == pa.fs.FileType.File and info.mtime and time.time() - info.mtime.timestamp() > stale_s:
                remove(path)
            elif time.monotonic() > until:
                raise TimeoutError(f"another run holds {path}") from None
            else:
                time.sleep(0.1)
    try:
        yield
    finally:
        remove(path)


def listing(spark: SparkSession, raw_root: str, parquet_root: str, tasks: DataFrame) -> DataFrame:
    """TASK, raw and parquet: which files of the tasks exist."""

    def known(root: str, suffix: str, name: str) -> DataFrame:
        found = [(p.split("/")[-2], p.split("/")[-1].removesuffix(suffix)) for p in find(root, suffix)]
        rows = spark.createDataFrame(found, "symbol string, day string")
        return rows.select("symbol", F.expr("try_to_date(day, 'yyyy-MM-dd')").alias("trade_date"), F.lit(True).alias(name))

    out = tasks.select(*TASK).distinct()
    for root, suffix, name in ((raw_root, ".tar.gz", "raw"), (parquet_root, ".parquet", "parquet")):
        out = out.join(known(root, suffix, name), TASK, "left")
    return out.select(*TASK, *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("raw", "parquet")))


def sizes(spark: SparkSession, root: str) -> DataFrame:
    """path and length of all files below root."""
    fs, _ = filesystem(root)
    rows = [(p, fs.get_file_info(filesystem(p)[1]).size) for p in find(root, "")]
    return spark.createDataFrame(rows, "path string, length long")


def clean_up(root: str, suffix: str = ".tmp") -> int:
    """Deletes what unfinished writes left; returns how many files."""
    paths = find(root, suffix)
    for p in paths:
        fs, inner = filesystem(p)
        fs.delete_file(inner)
    return len(paths)


def remove(path: str) -> None:
    """Deletes a file and its unfinished form, if they exist."""
    for p in (path, path + ".tmp"):
        fs, inner = filesystem(p)
        if fs.get_file_info(inner).type == pa.fs.FileType.File:
            fs.delete_file(inner)
