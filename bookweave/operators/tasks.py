"""Tasks: which days of which instruments to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: where archives are published, by day and instrument.
ARCHIVES = "https://static.okx.com/cdn/okx/match/orderbook/L2/400lv/daily"


def date_range(symbols: DataFrame, start: Column, end: Column) -> DataFrame:
    """Each symbol with each day from start to end, both included; none if end is before start."""
    days = F.when(end >= start, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return symbols.select("symbol", F.explode(days).alias("trade_date"))


def lookback(symbols: DataFrame, run_date: Column, days: int) -> DataFrame:
    """The ``days`` days before run_date, nearest first, with every symbol."""
    back = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("back")
    return symbols.select("symbol", run_date.alias("run_date"), back).select("symbol", F.date_sub("run_date", F.col("back")).alias("trade_date"))


#: White space as Unicode has it, at either end of a text.
ENDS = r"(?U)^\s+|\s+$"


def stripped(text: Column) -> Column:
    """text without white space of any kind at its ends."""
    return F.regexp_replace(text, ENDS, "")


def targets(lines: DataFrame) -> DataFrame:
    """lines: line_no, line (symbol:YYYY-MM-DD). symbol, trade_date and error; blank and # lines go."""
    text = stripped(F.col("line"))
    at = F.instr(text, ":")
    symbol, date = stripped(F.substr(text, F.lit(1), at - 1)), stripped(F.substr(text, at + 1))
    rows = lines.where((F.length(text) > 0) & ~text.startswith("#")).select("line_no", at.alias("at"), symbol.alias("symbol"), date.alias("date"))
    parsed = F.when(F.col("date").rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date("date", "yyyy-M-d"))
    error = F.when(F.col("at") == 0, "no colon between instrument and day").when(F.col("symbol") == "", "no instrument").when(F.col("date") == "", "no day").when(F.col("parsed").isNull(), F.concat("date", F.lit(" is no day")))
    rows = rows.withColumn("parsed", parsed).withColumn("error", error)
    ok = F.col("error").isNull()
    return rows.select("line_no", F.when(ok, F.col("symbol")).alias("symbol"), F.when(ok, F.col("parsed")).alias("trade_date"), "error")


def load_targets(lines: DataFrame) -> DataFrame:
    """The targets in order, repeated ones once; the first bad line, or none at all, is an error."""
    rows = targets(lines)
    bad = rows.where("error IS NOT NULL").orderBy("line_no").first()
    if bad:
        raise ValueError(f"target line {bad.line_no}: {bad.error}")
    found = rows.groupBy("symbol", "trade_date").agg(F.min("line_no").alias("line_no"))
    if found.isEmpty():
        raise ValueError("no targets")
    return found.orderBy("line_no").select("symbol", "trade_date")


def archive_url(symbol: Column, trade_date: Column, base: str = ARCHIVES) -> Column:
    return F.concat(F.lit(f"{base}/"), F.date_format(trade_date, "yyyyMMdd"), F.lit("/"), symbol, F.lit("-L2orderbook-400lv-"), F.date_format(trade_date, "yyyy-MM-dd"), F.lit(".tar.gz"))


def backoff_seconds(attempt: Column, most: int = 30) -> Column:
    """Wait before the attempt-th try of a download: doubling from 1 second; the first (0) doesn't wait."""
    return F.when(attempt > 0, F.least(F.pow(F.lit(2.0), attempt - 1), F.lit(float(most)))).otherwise(0.0).cast("long")


def not_available(trade_date: Column, cutoff: Column) -> Column:
    """What an absent archive means: final up to the cutoff, else to be tried again."""
    return F.when(trade_date <= cutoff, "not_available").otherwise("retry")


def raw_usage(files: DataFrame) -> DataFrame:
    """files: path, length. Bytes of archives and of those still being written."""
    raw = F.col("path").endswith(".tar.gz") | F.col("path").endswith(".tmp")
    return files.where(raw).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def in_order(start, end):
    """Whether a range of days is one; for dates and for columns."""
    return start <= end


def check_bounds(start, end) -> None:
    if not in_order(start, end):
        raise ValueError(f"end {end} is before start {start}")
