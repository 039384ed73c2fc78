"""Order-book records derived from the table ``events``, one level each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookweave.functions.scalars import epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_records(spark: SparkSession, sf_dir: str, first_snapshot: bool = True, shuffled: bool = False, bad_ts: bool = False) -> DataFrame:
    """first_snapshot: a day's first record is a snapshot. shuffled: another order of records, by seq and event_id. bad_ts: every 17th time can't be read."""
    events = table(spark, sf_dir, "events")
    seq = F.expr("event_id * 7919 % 100003") if shuffled else F.col("event_id")
    rows = events.select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("trade_date"), seq.alias("seq"), "event_id", epoch_ms(F.col("ts")).alias("ms"), "user_id", "value", F.get_json_object("props", "$.k").alias("k"))
    snapshot = F.col("event_id") % 40 == 0
    if first_snapshot:
        snapshot = snapshot | (F.row_number().over(Window.partitionBy("symbol", "trade_date").orderBy("seq", *["event_id"] * shuffled)) == 1)
    level = F.array(F.array(F.col("value").cast("string"), "k"))
    none = F.array().cast("array<array<string>>")
    bid = F.col("user_id") % 2 == 0
    ts = F.col("ms").cast("string")
    return rows.select(
        "symbol", "trade_date", "seq", "event_id",
        F.when(snapshot, "snapshot").otherwise("update").alias("action"),
        (F.when(F.col("event_id") % 17 == 0, "x").otherwise(ts) if bad_ts else ts).alias("ts"),
        F.when(bid, level).otherwise(none).alias("bids"), F.when(bid, none).otherwise(level).alias("asks"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON lines; every 997th line is bad."""
    rows = event_records(spark, sf_dir)
    line = F.to_json(F.struct("action", "ts", "bids", "asks"))
    return rows.select("symbol", "trade_date", "seq", F.when(F.col("event_id") % 997 == 0, "not-json").otherwise(line).alias("line"))
