"""K-d tree sharding: splits at distributed weighted medians along the widest metadata dimension.

The unit is a group of equal texts, which stays together; its weight is its bytes and its metadata are its
size, the ranks of its least source and least language among all, and its least doc_id. A node holds a
number of shards; it splits along the dimension that is widest relative to the whole table, where half of
its shards' share of the weight is reached: units are range-sorted by node, the node's dimension and
the text's hash, and a unit goes left if its middle lies within the share. All nodes of a level split in one
sort; a node is a number in a column, so nothing but one row of widths reaches the driver.

Null texts count as empty; size is UTF-8 bytes plus 1. A group of copies heavier than a shard stays
whole, so its shard exceeds the others. Null sources and languages rank first; a group without a doc_id has 0.
Repeated rows are rows of one group, each with its own slot. Slots run from 0 in each shard without gaps, in
order of doc_id (null first). Extra columns play no part or pass through ``shard_documents``; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookweave.llm.common import boxed, carried, settle

DIMS = ("size", "source", "lang", "doc_id")


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), text_key(F.col("text")).alias("key"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))


def running(rows: DataFrame, group: str, order: list[Column], weight: str) -> DataFrame:
    """Adds upto, the running sum of weight over a group's rows in order; group: a whole number that is not null.

    Rows are range-sorted over all tasks; each task sums its own rows and adds what stands before them, so no task
    holds a group. The result is settled but for that.
    """
    names = [f"_o{i}" for i in range(len(order))]
    by = [F.asc(group), *map(F.asc_nulls_first, names)]
    ordered = rows.withColumns(dict(zip(names, order, strict=True))).repartitionByRange(*by).sortWithinPartitions(*by).drop(*names).withColumn("_part", F.spark_partition_id())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g, w = batch.column(group).to_numpy(), batch.column(weight).to_numpy()
            total, new = np.cumsum(w), np.r_[g[0] != last, g[1:] != g[:-1]]
            before = np.r_[-carry, (total - w)[new]]  # of the group that goes on, and of each new one
            inside = total - before[np.cumsum(new)]
            last, carry = g[-1], int(inside[-1])
            yield batch.append_column("_in", pa.array(inside, pa.int64()))

    schema = ", ".join(f"`{c}` {t}" for c, t in ordered.dtypes)
    summed = settle(ordered.mapInArrow(sums, f"{schema}, _in long"))
    ahead = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that has rows of the group
    ends = summed.groupBy(group, "_part").agg(F.max("_in").alias("_sum")).withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    return summed.join(carried(ends), [group, "_part"]).withColumn("upto", F.col("_ahead") + F.col("_in")).drop("_part", "_ahead", "_in")


def ranked(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows with the named columns as dense ranks among all their values, 0 for null."""
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("_of"), F.col(c).alias("_value")) for n, c in enumerate(names)))).alias("v")
    values = rows.select(each).select("v.*").where("_value IS NOT NULL").distinct().withColumn("_one", F.lit(1).cast("long"))
    places = running(values, "_of", [F.col("_value")], "_one")
    for n, c in enumerate(names):
        mine = carried(places.where(F.col("_of") == n).select(F.col("_value").alias("_own"), F.col("upto").alias("_rank")))
        rows = rows.join(mine, F.col(c) == F.col("_own"), "left").withColumn(c, F.coalesce("_rank", F.lit(0)).cast("long")).drop("_own", "_rank")
    return rows


def units(rows: DataFrame) -> DataFrame:
    """A row for each group of equal texts: key, weight and DIMS as whole numbers."""
    found = rows.groupBy("key").agg(F.sum("size").alias("weight"), F.max("size").alias("size"), F.min("source").alias("source"), F.min("lang").alias("lang"), F.coalesce(F.min("doc_id").cast("long"), F.lit(0)).alias("doc_id"))
    return ranked(settle(found), ["source", "lang"])


def _widest(stats: DataFrame, root: list[float]) -> Column:
    """The number of the dimension that is widest relative to the root's; the first of equal ones."""
    width = [(F.col(f"_max{i}").cast("double") - F.col(f"_min{i}").cast("double")) / F.lit(root[i]) if root[i] else F.lit(0.0) for i in range(len(DIMS))]
    most, found = F.greatest(*width), F.lit(len(DIMS) - 1)
    for i in reversed(range(len(DIMS) - 1)):
        found = F.when(width[i] == most, i).otherwise(found)
    return found


def grow(tree: DataFrame, shards: int) -> DataFrame:
    """tree: units. Their key and shard. A node is its first shard and its number of shards."""
    tree = tree.withColumn("first", F.lit(0)).withColumn("shards", F.lit(max(shards, 1)))
    done, root = None, None
    for _ in range(math.ceil(math.log2(max(shards, 1)))):
        tree = settle(tree)
        leaves, tree = tree.where("shards = 1").select("key", "first"), tree.where("shards > 1")
        done = leaves if done is None else done.union(leaves)
        ends = [f(d).alias(f"_{f.__name__}{i}") for i, d in enumerate(DIMS) for f in (F.min, F.max)]
        stats = settle(tree.groupBy("first").agg(F.sum("weight").alias("total"), *ends))
        if root is None:
            whole = stats.first()  # of one row
            root = [float(whole[f"_max{i}"]) - float(whole[f"_min{i}"]) if whole else 0.0 for i in range(len(DIMS))]
        nodes = stats.select(F.col("first").alias("_node"), "total", _widest(stats, root).alias("dim"))
        value = F.element_at(F.array(*DIMS), F.col("dim") + 1)
        rows = running(tree.join(carried(nodes), F.col("first") == F.col("_node")).drop("_node"), "first", [value, F.col("key")], "weight")
        half = F.floor(F.col("shards") / 2).cast("int")
        left = (2 * F.col("upto") - F.col("weight")).cast("double") / 2 <= F.col("total").cast("double") * half / F.col("shards")
        tree = rows.select("key", "weight", *DIMS, F.when(left, F.col("first")).otherwise(F.col("first") + half).alias("first"), F.when(left, half).otherwise(F.col("shards") - half).alias("shards"))
    last = tree.select("key", "first")
    return (last if done is None else done.union(last)).withColumnRenamed("first", "shard")


def with_slots(rows: DataFrame) -> DataFrame:
    """Adds slot, gapless from 0 in each shard, in order of doc_id and text hash."""
    return running(rows.withColumn("_one", F.lit(1).cast("long")), "shard", [F.col("doc_id"), F.col("key")], "_one").withColumn("slot", F.col("upto") - 1).drop("_one", "upto")


def op5_sharding(docs: DataFrame, shards: int = 8) -> DataFrame:
    rows = settle(sizes(docs))
    homes = settle(grow(units(rows), shards))
    placed = rows.join(homes, "key")
    return with_slots(placed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, target_bytes: int | None = None, shards: int = 8) -> DataFrame:
    """The documents with their shard: ``shards`` of them, or as many as keep leaves near target_bytes."""
    rows = settle(units(sizes(docs)))
    if target_bytes:
        shards = max(1, math.ceil((rows.agg(F.sum("weight")).first()[0] or 0) / target_bytes))
    homes = settle(grow(rows, shards)).withColumnRenamed("key", "_key").withColumnRenamed("shard", "_shard")
    found = boxed(docs.drop("shard"), text_key(F.col("text")).alias("_own")).join(homes, F.col("_own") == F.col("_key"))
    return found.select("_row.*", F.col("_shard").alias("shard"))


def _level(n: int) -> str:
    """SQL of one level: every node of t{n} split into t{n + 1}."""
    width = [f"(CAST(max({d}) OVER node AS DOUBLE) - CAST(min({d}) OVER node AS DOUBLE)) / nullif((SELECT CAST(max({d}) AS DOUBLE) - CAST(min({d}) AS DOUBLE) FROM t0), 0)" for d in DIMS]
    pick = " ".join(f"WHEN w{i} = greatest(w0, w1, w2, w3) THEN {d}" for i, d in enumerate(DIMS))
    return f"""
w{n} AS (SELECT *, {', '.join(f'coalesce({w}, 0.0) AS w{i}' for i, w in enumerate(width))}, sum(weight) OVER node AS total FROM t{n} WINDOW node AS (PARTITION BY first)),
v{n} AS (SELECT *, CASE {pick} END AS v FROM w{n}),
u{n} AS (SELECT *, sum(weight) OVER (PARTITION BY first ORDER BY v, key ROWS UNBOUNDED PRECEDING) AS upto FROM v{n}),
t{n + 1} AS (SELECT key, weight, {', '.join(DIMS)}, shards // 2 AS shards, first + CASE WHEN CAST(2 * upto - weight AS DOUBLE) / 2 <= CAST(total AS DOUBLE) * (shards // 2) / shards THEN 0 ELSE shards // 2 END AS first FROM u{n})"""


#: The same tree by windows over whole nodes, for eight shards; crc32 by its table of 256 words.
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS words),
d AS (
  SELECT doc_id, md5(coalesce(text, '')) AS key, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, source, lang,
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))) AS bytes
  FROM documents),
g AS (SELECT key, CAST(sum(size) AS BIGINT) AS weight, max(size) AS size, min(source) AS source, min(lang) AS lang, coalesce(min(doc_id), 0) AS doc_id FROM d GROUP BY key),
t0 AS (SELECT key, weight, size, dense_rank() OVER (ORDER BY source NULLS FIRST) AS source, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS lang, doc_id, 8 AS shards, 0 AS first FROM g),""" + ",".join(_level(n) for n in range(3)) + """
SELECT doc_id, d.size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, words[CAST(1 + xor(c & 255, x) AS BIGINT)])), 4294967295) AS text_crc32, 'bytes' AS law, first AS shard,
  row_number() OVER (PARTITION BY first ORDER BY doc_id NULLS FIRST, key) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN t3 USING (key), crc
""".replace("SELECT doc_id, d.size", "SELECT d.doc_id, d.size").replace("ORDER BY doc_id NULLS FIRST, key", "ORDER BY d.doc_id NULLS FIRST, d.key")
