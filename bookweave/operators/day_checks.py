"""Per-day quality of archives and sampled books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookweave.operators.replay import DAY, book_columns

# Fixed value: the greatest share of bad lines that a day may have.
MAX_BAD_SHARE = 0.001


def bad_lines(parsed: DataFrame) -> DataFrame:
    """parsed: day, seq, ok, action. For each day its lines, bad ones, snapshots, and whether it fails for either."""
    counts = parsed.groupBy(*DAY).agg(F.count("*").alias("total"), F.count_if(~F.col("ok")).alias("bad"), F.count_if(F.col("action") == "snapshot").alias("snapshots"))
    share = F.col("bad") / F.col("total")
    return counts.withColumn("bad_share", share).withColumn("no_snapshot", F.col("snapshots") == 0).withColumn("failed", (F.col("snapshots") == 0) | (share > MAX_BAD_SHARE)).drop("snapshots")


def book_schema(depth: int = 20) -> T.StructType:
    return T.StructType([T.StructField("timestamp_ms", T.LongType(), False), *(T.StructField(c, T.FloatType()) for c in book_columns(depth))])


def schema_errors(df: DataFrame, depth: int = 20) -> list[str]:
    """What a table lacks to be a sampled book; further columns and their order don't matter."""
    have = {f.name: f.dataType for f in df.schema}
    out = []
    for field in book_schema(depth):
        if field.name not in have:
            out.append(f"the table lacks {field.name}")
        elif have[field.name] != field.dataType:
            out.append(f"{field.name} is {have[field.name].simpleString()}, not {field.dataType.simpleString()}")
    return out


def require_book(df: DataFrame, depth: int = 20) -> DataFrame:
    """The book's columns, or an error; a null timestamp fails when it is read."""
    errors = schema_errors(df, depth)
    if errors:
        raise ValueError("; ".join(errors))
    ok = F.coalesce(F.col("timestamp_ms"), F.raise_error(F.lit("a null among the times")).cast("long"))
    return df.withColumn("timestamp_ms", ok)


def expected_rows(first_ts: Column, last_ts: Column, sample_ms: int) -> Column:
    """Samples of a good day between its first and last record."""
    return F.floor(last_ts / sample_ms) - F.floor(first_ts / sample_ms)
