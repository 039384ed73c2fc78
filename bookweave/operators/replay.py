"""Order-book replay and sampling as a declarative plan.

Records have symbol, trade_date, seq (their order in the day), action, ts (text), bids and asks
(arrays of [price, quantity, ...] texts). A day's snapshots cut it into epochs; inside an epoch each
price level lives from the record that sets it to the next record that touches it. A sample at grid
time g shows the book after the first record at or past g. Books are ranked once for each record
that passes a grid point and repeated over the grid points it passes. Where seq repeats within a day,
order names the columns, seq first, that leave no ties; without it the result would follow the files' layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookweave.functions.scalars import DEPTH, SAMPLE_MS, price, price_key, quantity, timestamp_ms

DAY = ["symbol", "trade_date"]
SIDES = ("bid", "ask")
ORDER = ("seq",)


def epochs(records: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Records that act on the book, with epoch: how many snapshots the day has had, 0 before the first."""
    so_far = Window.partitionBy(*DAY).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    acting = records.where(F.col("action").isin("snapshot", "update"))
    return acting.withColumn("epoch", F.sum(F.when(F.col("action") == "snapshot", 1).otherwise(0)).over(so_far))


def keep(records: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Records from the first snapshot on, with ets (their time; one that can't be read is the last one, or 0) and pts (the time before)."""
    day = Window.partitionBy(*DAY).orderBy(*order)
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    found = epochs(records, order).where("epoch > 0")
    found = found.withColumn("ets", F.coalesce(F.last(timestamp_ms(F.col("ts")), ignorenulls=True).over(so_far), F.lit(0)))
    return found.withColumn("pts", F.lag("ets").over(day))


def levels(kept: DataFrame) -> DataFrame:
    """One row for each price level that a record sets: of equal keys the last counts, snapshots set no zeros."""

    def side(name: str, column: str):
        return F.transform(F.col(column), lambda l, i: F.struct(F.lit(name).alias("side"), i.alias("pos"), price_key(F.get(l, F.lit(0))).alias("px_key"), quantity(F.get(l, F.lit(1))).alias("qty")))

    both = F.concat(F.coalesce(side("bid", "bids"), F.array()), F.coalesce(side("ask", "asks"), F.array()))
    rows = kept.select(*DAY, "epoch", "seq", "action", F.inline(both))
    rows = rows.where("px_key IS NOT NULL AND qty IS NOT NULL AND (action = 'update' OR qty > 0)")
    return rows.groupBy(*DAY, "epoch", "seq", "side", "px_key").agg(F.max_by("qty", "pos").alias("qty"), F.max("pos").alias("pos"))


def intervals(rows: DataFrame) -> DataFrame:
    """How long each level holds its quantity: from seq to before next_seq, or the epoch's end."""
    level = Window.partitionBy(*DAY, "epoch", "side", "px_key").orderBy("seq")
    return rows.withColumn("next_seq", F.lead("seq").over(level)).where("qty > 0")


def triggers(kept: DataFrame, sample_ms: int = SAMPLE_MS) -> DataFrame:
    """Records that pass grid points, with the numbers of the first and last of them."""
    found = kept.where(f"pts IS NOT NULL AND ets DIV {sample_ms} > pts DIV {sample_ms}")
    return found.select(*DAY, "epoch", "seq", F.expr(f"pts DIV {sample_ms} + 1").alias("first_grid"), F.expr(f"ets DIV {sample_ms}").alias("last_grid"))


def ranked(at: DataFrame, live: DataFrame, depth: int, how: str) -> DataFrame:
    """The best levels of each side after each trigger's record, ranked from 0; how: inner, or left to keep triggers of empty books."""
    live = live.select(*(F.col(c).alias(f"_{c}") for c in (*DAY, "epoch", "seq", "next_seq")), "side", "px_key", "qty")
    same = [F.col(c) == F.col(f"_{c}") for c in (*DAY, "epoch")]
    open_ = (F.col("_seq") <= F.col("seq")) & (F.col("_next_seq").isNull() | (F.col("seq") < F.col("_next_seq")))
    held = at.join(live, [*same, open_], how)
    best_first = Window.partitionBy(*DAY, "seq", "side").orderBy(F.when(F.col("side") == "bid", -F.col("px_key")).otherwise(F.col("px_key")))
    found = held.withColumn("level", F.row_number().over(best_first)).where(F.col("level") <= depth)
    return found.select(*at.columns, "side", (F.col("level") - 1).alias("level"), "px_key", "qty")


def top_levels(at: DataFrame, live: DataFrame, depth: int = DEPTH) -> DataFrame:
    """A row for each of the best levels after each trigger's record."""
    return ranked(at, live, depth, "inner").select(*DAY, "seq", "side", "level", "px_key", "qty")


def book_columns(depth: int = DEPTH) -> list[str]:
    return [f"{side}_{kind}_{i}" for side in SIDES for i in range(depth) for kind in ("px", "sz")]


def books(at: DataFrame, live: DataFrame, depth: int = DEPTH) -> DataFrame:
    """A wide row for each trigger; levels that the book lacks are null."""
    cells = []
    for name in book_columns(depth):
        side, kind, i = name.split("_")
        here = (F.col("side") == side) & (F.col("level") == int(i))
        cells.append(F.max(F.when(here, price(F.col("px_key")) if kind == "px" else F.col("qty"))).alias(name))
    return ranked(at, live, depth, "left").groupBy(*DAY, "seq", "first_grid", "last_grid").agg(*cells)


def spread(rows: DataFrame, sample_ms: int = SAMPLE_MS) -> DataFrame:
    """Repeats each trigger's row over its grid points, as timestamp_ms."""
    times = F.transform(F.sequence("first_grid", "last_grid"), lambda g: g * sample_ms)
    others = [c for c in rows.columns if c not in (*DAY, "seq", "first_grid", "last_grid")]
    return rows.select(*DAY, F.explode(times).alias("timestamp_ms"), *others)


def regressions(kept: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """For each day, its first record that is older than the one before, if any; such a day fails."""
    older = F.col("ets") < F.col("pts")
    first = F.min_by(F.struct("seq", "ets", "pts"), F.when(older, F.struct(*order)))
    found = kept.groupBy(*DAY).agg(F.count_if(older).alias("regressions"), first.alias("at"))
    failed = F.col("regressions") > 0
    return found.select(*DAY, failed.alias("failed"), *(F.when(failed, F.col(f"at.{c}")).alias(n) for c, n in (("seq", "bad_seq"), ("ets", "bad_ts"), ("pts", "current_ts"))))


def flagged_days(kept: DataFrame) -> DataFrame:
    """kept without the days that fail, in the one pass that its windows make; a day's rows are held, and spilled, until its end is seen."""
    older = F.max(F.coalesce(F.col("ets") < F.col("pts"), F.lit(False))).over(Window.partitionBy(*DAY))
    return kept.withColumn("_older", older).where("NOT _older").drop("_older")


def samples(records: DataFrame, sample_ms: int = SAMPLE_MS, depth: int = DEPTH) -> DataFrame:
    """The sampled book of all good days: symbol, trade_date, timestamp_ms and the wide columns."""
    return spread(sampled_books(records, sample_ms, depth), sample_ms)


def sampled_books(records: DataFrame, sample_ms: int = SAMPLE_MS, depth: int = DEPTH) -> DataFrame:
    """The book after each record that passes grid points."""
    kept = flagged_days(keep(records))
    return books(triggers(kept, sample_ms), intervals(levels(kept)), depth)
