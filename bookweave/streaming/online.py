"""Online replay: the sampled book of records that keep arriving, by Structured Streaming.

Each (symbol, trade_date) keeps its book, its last time and whether it has failed. Inside a micro-batch
records go by seq; across batches they must arrive in order, as a late record is a regression, which
ends its day: samples so far stand and the day emits no more.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bookweave.functions.scalars import DEPTH, SAMPLE_MS, price_key, quantity, timestamp_ms
from bookweave.operators.fused import LADDERS, Book, _cell, wide
from bookweave.operators.replay import DAY


def online_books(records: DataFrame, sample_ms: int = SAMPLE_MS, depth: int = DEPTH) -> DataFrame:
    """records: a stream as replay takes it. A row for each record that passes grid points, as replay.sampled_books gives."""
    def levels(column: str):
        return F.transform(F.col(column), lambda l: F.struct(price_key(F.get(l, F.lit(0))).alias("px_key"), quantity(F.get(l, F.lit(1))).alias("qty")))

    rows = records.where(F.col("action").isin("snapshot", "update"))
    rows = rows.select(*DAY, "seq", (F.col("action") == "snapshot").alias("snapshot"), timestamp_ms(F.col("ts")).alias("ms"), levels("bids").alias("bids"), levels("asks").alias("asks"))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        book, last, failed = pickle.loads(state.get[0]) if state.exists else (Book(), None, False)
        out = []
        batch = pd.concat(list(frames)).sort_values("seq")
        for seq, snapshot, ms, bids, asks in batch[["seq", "snapshot", "ms", "bids", "asks"]].itertuples(index=False):
            if failed or (last is None and not snapshot):
                continue
            now = (last or 0) if pd.isna(ms) else int(ms)
            if last is not None and now < last:
                failed = True
                continue
            book.apply(snapshot, [x if isinstance(x, dict) else x.asDict() for x in bids], [x if isinstance(x, dict) else x.asDict() for x in asks])
            if last is not None and _cell(now, sample_ms) > _cell(last, sample_ms):
                out.append((*key, seq, _cell(last, sample_ms) + 1, _cell(now, sample_ms), *book.top(depth)))
            last = now
        state.update((pickle.dumps((book, last, failed)),))
        if out:
            yield pd.DataFrame(out, columns=[f.split()[0] for f in LADDERS.split(", ")])

    found = rows.groupBy(*DAY).applyInPandasWithState(step, LADDERS, "state binary", "append", GroupStateTimeout.NoTimeout)
    return wide(found, depth)
