"""The daily run: fetch archives, replay them, write books, keep the ledger.

Work goes in waves. A wave fetches a bounded number of archives with bounded concurrency, one Spark
job replays all that arrived, and the ledger takes what happened; tasks that failed come again in a
later wave, through the download, until their retries are used up. A bad day fails alone. Raw files go
once their day is settled in the ledger, so a crash repeats no finished work.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.functions.scalars import DEPTH, SAMPLE_MS
from bookweave.functions.strict_json import parsed
from bookweave.operators import day_checks, fused, ledger, replay, tasks
from bookweave.operators.ledger import TASK
from bookweave.session import settle
from bookweave.sources import archive, book_files, ledger_files

#: (symbol, day, path) -> True if the archive is there now, False if none is published; raises OSError to be tried again.
Fetch = Callable[[str, date, str], bool]


@dataclass
class Config:
    raw_root: str
    parquet_root: str
    ledger_root: str
    concurrency: int = 4
    tries: int = 5
    retries: int = 3
    retry_delay_s: float = 60
    raw_max_bytes: int = 70 << 30
    wave: int = 64
    cutoff: date | None = None  # absent archives up to this day are final; two days ago if None
    sample_ms: int = SAMPLE_MS
    depth: int = DEPTH


def fetch_http(symbol: str, day: date, path: str, base: str = tasks.ARCHIVES, timeout: float = 120) -> bool:
    """Fetches one archive by HTTP; checks its length and that it can be read to the end."""
    url = f"{base}/{day:%Y%m%d}/{symbol}-L2orderbook-400lv-{day:%Y-%m-%d}.tar.gz"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as reply:
            length = reply.headers.get("Content-Length")
            book_files.publish(path, reply, None if length is None else int(length))
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return False
        raise
    wrong = archive.valid(path)
    if wrong:
        ledger_files.remove(path)
        raise OSError(wrong)
    return True


def fetched(todo: DataFrame, config: Config, fetch: Fetch) -> DataFrame:
    """todo: TASK. Adds kind (an event of the ledger, or not_available) and reason; waits between tries double.

    Before each archive the raw files are measured: at the cap a task is deferred, untried, so the cap holds but for the archives under way.
    """
    schema = pa.schema([("symbol", pa.string()), ("trade_date", pa.date32()), ("kind", pa.string()), ("reason", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path = book_files.day_path(config.raw_root, row["symbol"], row["trade_date"], archive.SUFFIX)
                kind, reason = "download_failure", None
                full = archive.usage(config.raw_root) >= config.raw_max_bytes
                kind = "deferred" if full else kind
                for attempt in range(0 if full else config.tries + 1):
                    if attempt:
                        time.sleep(min(2 ** (attempt - 1), 30))
                    try:
                        kind = "download_success" if fetch(row["symbol"], row["trade_date"], path) else "not_available"
                        reason = None
                        break
                    except OSError as e:
                        reason = str(e) or type(e).__name__
                yield pa.RecordBatch.from_pylist([row | {"kind": kind, "reason": reason}], schema)

    return todo.select(*TASK).repartition(config.concurrency).mapInArrow(work, "symbol string, trade_date date, kind string, reason string")


def processed(spark: SparkSession, todo: DataFrame, config: Config) -> DataFrame:
    """Replays the archives of todo (TASK) that exist and writes their books: TASK, kind, reason, rows."""
    paths = [book_files.day_path(config.raw_root, r.symbol, r.trade_date, archive.SUFFIX) for r in todo.select(*TASK).collect()]  # a wave of tasks
    lines = archive.read_archives(spark, *paths)
    lines = lines.withColumn("line", F.coalesce("line", F.lit(" ")))  # a broken archive's row is read like any other
    records = settle(parsed(lines), "wave")  # archives are read and parsed once
    broken = records.where("error IS NOT NULL").groupBy(*TASK).agg(F.min("error").alias("why"))
    records = records.where("error IS NULL").drop("error")
    checks = day_checks.bad_lines(records)
    kept = settle(replay.keep(records.where("ok")), "wave")  # the windows run once
    older = replay.regressions(kept)
    state = todo.select(*TASK).join(broken, TASK, "left").join(checks, TASK, "left").join(older.withColumnRenamed("failed", "older"), TASK, "left")
    share = F.format_string("%d of %d lines are bad, more than %.1f %% of them", "bad", "total", F.lit(day_checks.MAX_BAD_SHARE * 100))
    reason = F.when(F.col("why").isNotNull(), F.col("why")).when(F.col("total").isNull(), "the archive is not there or has no lines").when(F.col("older"), F.format_string("a record of time %d follows one of time %d", "bad_ts", "current_ts"))
    reason = reason.when(F.col("no_snapshot"), "the day has no snapshot").when(F.col("failed"), share)
    state = settle(state.select(*TASK, reason.alias("reason")), "wave")
    good = state.where("reason IS NULL").select(*TASK)
    books = fused.wide(fused.ladders(kept.join(good, TASK), config.sample_ms, config.depth), config.depth)
    written = book_files.write_sorted_days(replay.spread(books, config.sample_ms), config.parquet_root).collect()  # a row for each day of the wave
    rows = [(p.split("/")[-2], date.fromisoformat(p.split("/")[-1].removesuffix(book_files.PARQUET)), n) for p, n in written]
    out = state.join(spark.createDataFrame(rows, "symbol string, trade_date date, rows long"), TASK, "left")
    reason = F.coalesce("reason", F.when(F.col("rows").isNull(), "the day gives no samples"))
    return out.select(*TASK, F.when(reason.isNull(), "process_success").otherwise("process_failure").alias("kind"), reason.alias("reason"), "rows")


def transition(states: DataFrame, events: DataFrame) -> DataFrame:
    """states after one event each: TASK, kind, reason, rows."""
    event = events.select(*TASK, F.col("kind"), F.col("reason"), F.col("rows").alias("_rows"))
    joined = states.join(event, TASK)
    kind = F.col("kind")
    done = kind.isin("process_success", "process_failure")
    down = F.when(kind == "download_success", "success").when(kind == "download_failure", "failed").when(kind == "not_available", "not_available").otherwise(F.col("download"))
    return ledger.normalized(joined.select(
        *TASK, down.alias("download"), F.when(kind == "process_success", "success").when(kind == "process_failure", "failed").otherwise(F.col("process")).alias("process"),
        (F.col("download_attempts") + (~done).cast("int")).alias("download_attempts"), (F.col("process_attempts") + done.cast("int")).alias("process_attempts"),
        F.when(kind == "process_success", F.col("_rows")).alias("rows"), (kind != "download_success").alias("raw_deleted"), F.when(kind.isin("download_failure", "process_failure"), F.col("reason")).alias("last_error"),
    ))


def update(spark: SparkSession, root: str, events: DataFrame) -> None:
    """Reads the states of the events' tasks, applies one event each and writes them, as the ledger's only writer meanwhile."""
    with ledger_files.locked(spark, root):
        ledger_files.write_states(transition(ledger_files.read_states(spark, root, events), events), root)


def _record(spark: SparkSession, config: Config, rows: list[tuple]) -> None:
    """rows: symbol, day, kind, reason, rows."""
    if rows:
        update(spark, config.ledger_root, spark.createDataFrame(rows, "symbol string, trade_date date, kind string, reason string, rows long"))


def run(spark: SparkSession, todo: list[tuple[str, date]], config: Config, fetch: Fetch = fetch_http, process: Callable[[SparkSession, DataFrame, Config], DataFrame] = processed, sleep: Callable[[float], None] = time.sleep) -> dict[str, int]:
    """Brings every task (symbol, day) to an end; returns how many ended each way."""
    todo = list(dict.fromkeys(todo))
    cutoff = config.cutoff or date.today() - timedelta(days=2)
    for root in (config.raw_root, config.parquet_root):
        ledger_files.clean_up(root)
    frame = lambda keys: spark.createDataFrame(keys, "symbol string, trade_date date")
    raw = lambda key: book_files.day_path(config.raw_root, *key, archive.SUFFIX)
    report = {"success": 0, "not_available": 0, "failed": 0}
    if not todo:
        return report
    everything = frame(todo)
    states = ledger_files.read_states(spark, config.ledger_root, everything)
    files = ledger_files.listing(spark, config.raw_root, config.parquet_root, everything)
    route = {(r.symbol, r.trade_date): r.queue for r in ledger.route(everything, states, files).collect()}  # a row for each task
    used: dict[tuple[str, date], int] = {}
    for key in todo:
        if route[key] in ("done", "skip"):
            ledger_files.remove(raw(key))
            report["success" if route[key] == "done" else "not_available"] += 1
    queue = [k for k in todo if route[k] in ("process", "download")]
    waiting = {k for k in queue if route[k] == "process"}  # archives that are there already
    wave = config.wave
    while queue:
        now, queue = queue[:wave], queue[wave:]
        events = [(*k, "present", None) for k in now if k in waiting]
        missing = [k for k in now if k not in waiting]
        waiting -= set(now)
        events += [tuple(r) for r in fetched(frame(missing), config, fetch).collect()] if missing else []
        settled, again, arrived = [], [], []
        for symbol, day, kind, reason in events:
            key = (symbol, day)
            if kind == "deferred":
                queue.insert(0, key)
            elif kind in ("present", "download_success"):
                arrived.append(key)
                settled += [(*key, kind, None, None)] * (kind != "present")
            elif kind == "not_available" and day <= cutoff:
                settled.append((*key, kind, None, None))
                report["not_available"] += 1
            else:
                why = f"not published yet: {day} is after {cutoff}" if kind == "not_available" else reason
                settled.append((*key, "download_failure", why, None))
                again.append(key)
        if events and all(kind == "deferred" for _, _, kind, _ in events):
            raise ValueError(f"files below {config.raw_root} that no task waits for fill the cap of {config.raw_max_bytes} bytes")
        _record(spark, config, settled)
        ends = []
        if arrived:
            usage = tasks.raw_usage(ledger_files.sizes(spark, config.raw_root)).first().bytes
            wave = max(1, min(config.wave, int(config.raw_max_bytes * len(now) / usage))) if usage else config.wave  # the next wave keeps to the cap
            ends = [tuple(r) for r in process(spark, frame(arrived), config).collect()]
            _record(spark, config, ends)
        for symbol, day, kind, _, _ in ends:
            ledger_files.remove(raw((symbol, day)))
            if kind == "process_success":
                report["success"] += 1
            else:
                ledger_files.remove(book_files.day_path(config.parquet_root, symbol, day, book_files.PARQUET))
                again.append((symbol, day))
        for key in again:
            ledger_files.remove(raw(key))
            used[key] = used.get(key, 0) + 1
            if used[key] > config.retries:
                report["failed"] += 1
            else:
                queue.append(key)
        if queue and all(key in used for key in queue):  # only retries are left
            sleep(config.retry_delay_s)
    return report


def daily(spark: SparkSession, symbols: list[str], run_date: date, lookback: int, config: Config, transfer_root: str, fetch: Fetch = fetch_http, copies: dict[str, str] | None = None, summary: str | None = None, clean: bool = False, level: int = 19, verify: bool = False) -> dict[str, int]:
    """The day's round: the days before run_date are brought to an end, their books coded, both copied to other folders, and what is left over deleted.

    copies: books, blobs and logs by the folder they go to. Days that failed end the round before anything is coded or copied. clean: the
    round's books and blobs go once they are copied. No folder is deleted, and books of other days stay.
    """
    todo = [(s, run_date - timedelta(days=n)) for n in range(1, lookback + 1) for s in symbols]
    report = run(spark, todo, config, fetch)
    if summary:
        write_summary(spark, list(dict.fromkeys(todo)), config, summary)
    if report["failed"]:
        return report
    roots = {"books": config.parquet_root, "blobs": transfer_root, "logs": summary.rpartition("/")[0] if summary else ""}
    done = book_files.encode_tree(spark, config.parquet_root, transfer_root, level=level, verify=verify).where("status = 'failed'").collect()
    for kind, target in (copies or {}).items():
        if roots[kind]:
            done += book_files.copy_tree(spark, roots[kind], target).where("status = 'failed'").collect()
    if done:  # rows of files that failed alone
        raise OSError("; ".join(f"{r.input}: {r.error}" for r in done))
    for root in (config.raw_root, config.parquet_root, transfer_root):
        ledger_files.clean_up(root)
    for key in todo if clean and copies else ():
        ledger_files.remove(book_files.day_path(config.parquet_root, *key, book_files.PARQUET))
        ledger_files.remove(book_files.day_path(transfer_root, *key, book_files.BLOB))
    return report


def write_summary(spark: SparkSession, todo: list[tuple[str, date]], config: Config, path: str) -> None:
    """A CSV line for each task, in the order of the tasks."""
    rows = spark.createDataFrame([(n, *k) for n, k in enumerate(todo)], "n long, symbol string, trade_date date")
    lines = ledger.summary(rows, ledger_files.read_states(spark, config.ledger_root, rows)).orderBy("n").collect()  # a row for each task
    book_files.publish(path, "".join(f"{x}\n" for x in ["inst,tradedate,status,rows,error", *(r.line for r in lines)]).encode())
