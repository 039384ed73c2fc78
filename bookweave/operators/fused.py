"""The same replay as one ordered pass over each day, for full-rate data.

A full-rate day has one epoch, hundreds of live levels and a trigger for nearly every grid point, so
the joined plan would rank every live level again for each. This pass keeps the book in memory, does
the work of an ordered map for each level and gives the same rows. Records arrive sorted inside
partitions; memory holds one book and a few thousand output rows, whatever the length of the day.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookweave.functions.scalars import DEPTH, SAMPLE_MS, price, price_key, quantity
from bookweave.operators.replay import DAY, book_columns, flagged_days, keep, spread


def _cell(ms: int, width: int) -> int:
    """ms / width towards zero."""
    return ms // width if ms >= 0 else -(-ms // width)


class Side:
    """Quantities by key, with the keys in order, best first."""

    def __init__(self):
        self.held: dict[int, float] = {}
        self.order: list[int] = []

    def clear(self) -> None:
        self.held.clear()
        self.order.clear()

    def put(self, key: int, qty: float) -> None:
        if key not in self.held:
            insort(self.order, key)
        self.held[key] = qty

    def drop(self, key: int) -> None:
        if self.held.pop(key, None) is not None:
            del self.order[bisect_left(self.order, key)]


class Book:
    """Bids under negated keys, so that both sides start with their best."""

    def __init__(self):
        self.sides = {"bids": Side(), "asks": Side()}

    def apply(self, snapshot: bool, bids: list, asks: list) -> None:
        for name, rows, sign in (("bids", bids, -1), ("asks", asks, 1)):
            side = self.sides[name]
            if snapshot:
                side.clear()
            for level in rows or ():
                key, qty = level["px_key"], level["qty"]
                if key is None or qty is None:
                    continue
                if qty > 0:
                    side.put(sign * key, qty)
                elif not snapshot:
                    side.drop(sign * key)

    def top(self, depth: int) -> list[list]:
        """For each side, keys and quantities of its best levels."""
        out = []
        for name, sign in (("bids", -1), ("asks", 1)):
            side = self.sides[name]
            keys = side.order[:depth]
            out += [[sign * k for k in keys], [side.held[k] for k in keys]]
        return out


LADDERS = "symbol string, trade_date date, seq long, first_grid long, last_grid long, bid array<long>, bid_qty array<float>, ask array<long>, ask_qty array<float>"


def ladders(kept: DataFrame, sample_ms: int = SAMPLE_MS, depth: int = DEPTH) -> DataFrame:
    """kept: as replay.keep gives it, of good days. For each record that passes grid points, the best keys and quantities of each side.

    The window that numbers a day's records deals and sorts them; where kept comes from windows over the same days
    it needs no shuffle of its own. Days follow each other whole and in order.
    """

    def parsed(column: str):
        return F.transform(F.col(column), lambda l: F.struct(price_key(F.get(l, F.lit(0))).alias("px_key"), quantity(F.get(l, F.lit(1))).alias("qty")))

    place = F.row_number().over(Window.partitionBy(*DAY).orderBy("seq"))
    ordered = kept.select(*DAY, "seq", (F.col("action") == "snapshot").alias("snapshot"), "ets", "pts", parsed("bids").alias("bids"), parsed("asks").alias("asks"), place.alias("place"))
    whole, part = pa.list_(pa.int64()), pa.list_(pa.float32())
    schema = pa.schema([("symbol", pa.string()), ("trade_date", pa.date32()), ("seq", pa.int64()), ("first_grid", pa.int64()), ("last_grid", pa.int64()), ("bid", whole), ("bid_qty", part), ("ask", whole), ("ask_qty", part)])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, rows, last = Book(), [], 0
        for batch in batches:
            for symbol, date, seq, snapshot, ets, pts, bids, asks, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n == 1:
                    book = Book()
                elif n != last + 1:
                    raise ValueError(f"records of {symbol} {date} are out of order")
                last = n
                book.apply(snapshot, bids, asks)
                if pts is not None and _cell(ets, sample_ms) > _cell(pts, sample_ms):
                    rows.append((symbol, date, seq, _cell(pts, sample_ms) + 1, _cell(ets, sample_ms), *book.top(depth)))
                    if len(rows) >= 4096:
                        yield table(rows)
                        rows = []
        if rows:
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return ordered.mapInArrow(replay, LADDERS)


def wide(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """ladders' rows with a column for each cell of the book; levels that it lacks are null."""
    cells = []
    for name in book_columns(depth):
        side, kind, i = name.split("_")
        cells.append((price(F.get(side, F.lit(int(i)))) if kind == "px" else F.get(f"{side}_qty", F.lit(int(i)))).alias(name))
    return rows.select(*DAY, "seq", "first_grid", "last_grid", *cells)


def long(rows: DataFrame) -> DataFrame:
    """ladders' rows as replay.top_levels gives them: one for each level."""

    def levels(side: str):
        return F.transform(side, lambda key, i: F.struct(F.lit(side).alias("side"), i.alias("level"), key.alias("px_key"), F.get(f"{side}_qty", i).alias("qty")))

    return rows.select(*DAY, "seq", F.inline(F.concat(levels("bid"), levels("ask"))))


def sampled_books(records: DataFrame, sample_ms: int = SAMPLE_MS, depth: int = DEPTH) -> DataFrame:
    """As replay.sampled_books; times are read and days checked in the JVM, in the windows that also deal and sort the records."""
    return wide(ladders(flagged_days(keep(records)), sample_ms, depth), depth)


def samples(records: DataFrame, sample_ms: int = SAMPLE_MS, depth: int = DEPTH) -> DataFrame:
    return spread(sampled_books(records, sample_ms, depth), sample_ms)
