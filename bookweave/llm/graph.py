"""Connected components of a distributed graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.llm.common import settle
from bookweave.session import release

#: Edges up to which one task settles the whole graph (16 bytes each); rounds of joins would take longer.
SMALL = 1 << 20


def _one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not parts:
        return
    names, at = np.unique(np.concatenate([np.concatenate(x) for x in zip(*parts, strict=True)]), return_inverse=True)
    a, b = at[: len(at) // 2], at[len(at) // 2 :]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (label[a], label[b]):
            np.minimum.at(new, end, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[label])], names=["node", "root"])


def components(edges: DataFrame, most_rounds: int = 60, small: int = SMALL) -> DataFrame:
    """edges: a, b. Returns node, root for every node that has an edge; root is the least node of its component.

    A graph of at most ``small`` edges is settled by one task. A larger one alternates large and small
    stars: every node hands its neighbours to the least one it knows, until nothing changes. Each round's
    edges are written to shared storage, and so are the least neighbours, so that joins read them by
    exchanges that Spark can split where a node is hot. Nulls are not allowed.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sums = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = edges.agg(*sums).first()
    if before.n <= small:
        return settle(edges.coalesce(1).mapInArrow(_one_task, "node long, root long"))
    for _ in range(most_rounds):
        # large star: each node's greater neighbours go to the least of its neighbours and itself
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: each node and its lesser neighbours go to the least of them
        large = settle(large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        low = settle(large.groupBy("a").agg(F.min("b").alias("m")))
        stars = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct()
        new = settle(stars)
        after = new.agg(*sums).first()
        release(least, large, low)
        if after == before:
            break
        release(edges)
        edges, before = new, after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
