"""The ledger: what has happened to each task, as a table folded from events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.functions.scalars import csv_field

TASK = ["symbol", "trade_date"]
DAY_STATE = "download string, process string, download_attempts int, process_attempts int, rows long, raw_present boolean, parquet_present boolean, task_status string, raw_deleted boolean, last_error string, updated_at string, downloaded boolean, not_available boolean, processed boolean, validated boolean"
KINDS = ("download_success", "download_failure", "not_available", "process_success", "process_failure")


def normalized(states: DataFrame) -> DataFrame:
    """states: download, process, raw_deleted and others. Sets the flags and the status that follow from them."""
    down, done = F.col("download"), F.col("process")
    status = F.when(down == "not_available", "not_available").when(done == "success", "success").when((down == "failed") | (done == "failed"), "failed").otherwise("pending")
    return states.withColumns({
        "downloaded": down == "success", "not_available": down == "not_available", "processed": done == "success", "validated": done == "success",
        "raw_present": (down == "success") & ~F.col("raw_deleted"), "parquet_present": done == "success", "task_status": status,
    })


def from_legacy(rows: DataFrame) -> DataFrame:
    """rows: TASK and old flags downloaded, not_available, processed, validated, raw_deleted, download_attempts, rows (null: missing)."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    tries = F.coalesce(F.col("download_attempts"), F.lit(0))
    download = F.when(flag("not_available"), "not_available").when(flag("downloaded"), "success").when(tries > 0, "failed").otherwise("pending")
    done = flag("processed") | flag("validated")
    return rows.select(
        *TASK, download.alias("download"), F.when(done, "success").otherwise("pending").alias("process"), tries.cast("int").alias("download_attempts"), F.lit(0).alias("process_attempts"), "rows",
        (flag("downloaded") & ~flag("raw_deleted")).alias("raw_present"), done.alias("parquet_present"), F.lit("pending").alias("task_status"), flag("raw_deleted").alias("raw_deleted"),
        *(flag(c).alias(c) for c in ("downloaded", "not_available", "processed", "validated")),
    )


def fold(events: DataFrame) -> DataFrame:
    """events: TASK, seq, kind (of KINDS), reason, rows. The state of each task after all its events.

    Every transition sets whole fields, so the last event that sets a field decides; no order but seq is needed and partial results combine.
    """
    kind = F.col("kind")
    down = F.when(kind == "download_success", "success").when(kind == "download_failure", "failed").when(kind == "not_available", "not_available")
    done = F.when(kind == "process_success", "success").when(kind == "process_failure", "failed")
    failure = kind.isin("download_failure", "process_failure")
    last = lambda value: F.max_by(value, "seq")
    states = events.groupBy(*TASK).agg(
        F.coalesce(F.max_by(down, F.when(down.isNotNull(), F.col("seq"))), F.lit("pending")).alias("download"),
        F.coalesce(F.max_by(done, F.when(done.isNotNull(), F.col("seq"))), F.lit("pending")).alias("process"),
        F.count(down).cast("int").alias("download_attempts"),
        F.count(done).cast("int").alias("process_attempts"),
        last(F.when(kind == "process_success", F.col("rows"))).alias("rows"),
        last(kind != "download_success").alias("raw_deleted"),
        last(F.when(failure, F.col("reason"))).alias("last_error"),
    )
    return normalized(states)


def route(tasks: DataFrame, states: DataFrame, files: DataFrame) -> DataFrame:
    """tasks: TASK; states: TASK, task_status; files: TASK, raw, parquet (whether they exist). Adds queue: done, skip, process or download."""
    rows = tasks.join(states.select(*TASK, "task_status"), TASK, "left").join(files, TASK, "left")
    raw, parquet = (F.coalesce(F.col(c), F.lit(False)) for c in ("raw", "parquet"))
    queue = F.when((F.col("task_status") == "success") & parquet, "done").when(F.col("task_status") == "not_available", "skip").when(raw & ~parquet, "process").otherwise("download")
    return rows.select(*TASK, queue.alias("queue"))


def summary(tasks: DataFrame, states: DataFrame) -> DataFrame:
    """tasks: TASK, n (their order). One CSV line for each task, without its line end."""
    rows = tasks.join(states.select(*TASK, "task_status", "rows", "last_error"), TASK, "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    cells = [csv_field(F.col("symbol")), F.date_format("trade_date", "yyyy-MM-dd"), F.coalesce("task_status", F.lit("pending")), text("rows"), csv_field(text("last_error"))]
    return rows.select("n", F.concat_ws(",", *cells).alias("line"))


def report(states: DataFrame) -> DataFrame:
    """How many tasks ended each way."""
    counts = [F.count_if(F.col("task_status") == s).alias(f"{s}_count") for s in ("success", "not_available", "failed")]
    return states.agg(*counts).withColumn("ok", F.col("failed_count") == 0)
