"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Documents of a source are shuffled by a hash and queue up to three times over. An item's virtual
finish time is its source's tokens up to and with it, divided by the source's target. All items are
range-sorted by finish time and the mix ends where the total budget, the sum of all sizes, is spent.

Targets share all tokens by weight (5, 2, 1, repeating over sources by code point, null last); none
exceeds three times its source's size and the excess goes to the others by weight. Only whole
documents are taken. Null texts and texts without words have size 0 and take no tokens; a source
without tokens has target 0. Rows of equal id queue by size; equal rows get one result each. Extra
columns pass through ``mix``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookweave.llm.common import boxed, settle, unboxed, word_count

WEIGHTS, COPIES, ROWS, ITEMS = (5, 2, 1), 3, 512, 1 << 16
SEED = "mix-1:"


def targets(totals: DataFrame) -> DataFrame:
    """totals: a row for each source with its size. Adds weight and target, by filling up to one water level."""
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weights = F.array(*map(F.lit, WEIGHTS))
    rows = totals.withColumn("weight", F.element_at(weights, (F.pmod(rank, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("long")).withColumn("cap", F.col("source_size") * COPIES)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / share)
    open_ = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    rows = rows.withColumn("level", F.first(open_, ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.select("source", "source_size", "weight", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def shuffle_key(doc_id):
    return F.conv(F.substring(F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def queue(rows: DataFrame) -> DataFrame:
    """rows: _row columns, doc_id, source, size. Adds source_size, target and upto: the source's tokens up to and with the row.

    A prefix sum in two steps: over equal slices of the shuffled source, then inside each slice, so no task holds a source.
    """
    slices = 1 << min(16, max(0, (rows.count() // ROWS).bit_length()))
    rows = rows.withColumn("_key", shuffle_key(F.col("doc_id"))).withColumn("_slice", F.floor(F.col("_key") / F.lit((1 << 60) // slices)))
    sums = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    goal = targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")))
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    goal, sums = (x.withColumnRenamed("source", "_source") for x in (goal, sums.withColumnRenamed("_slice", "_at").drop("_sum")))
    sums = sums.join(goal.withColumnRenamed("_source", "_goal"), F.col("_source").eqNullSafe(F.col("_goal"))).drop("_goal")
    inside = Window.partitionBy("source", "_slice").orderBy("_key", F.asc_nulls_last("doc_id"), "size").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.sum("size").over(inside))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_at")), "left")
    return rows.withColumn("upto", F.col("_ahead") + F.col("_in")).drop("_source", "_at", "_ahead", "_in", "_slice", "weight")


def finish(copy) -> Column:
    """Virtual finish time of a copy (0, 1, 2) of a queued row."""
    return F.when(F.col("target") > 0, (copy * F.col("source_size") + F.col("upto")).cast("double") / F.col("target"))


def sorted_items(queued: DataFrame) -> DataFrame:
    """at and size of all copies that can be taken, range-sorted by finish time over tasks of about ``ITEMS`` rows, with the task (_part); settled."""
    items = queued.where("size > 0 and target > 0").select("size", F.explode(F.array(*(finish(F.lit(i)) for i in range(COPIES)))).alias("at"))
    tasks = min(20_000, 1 + items.count() // ITEMS)
    return settle(items.repartitionByRange(tasks, "at").sortWithinPartitions("at").withColumn("_part", F.spark_partition_id()))


def last_finish(ordered: DataFrame, budget: int) -> float:
    """The greatest finish time up to which all sorted items together keep to the budget.

    Whole tasks are added up in order; only the one in which the budget ends is looked into.
    """
    upto = lambda *by: F.sum("n").over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    sums = ordered.groupBy("_part").agg(F.sum("size").alias("n"), F.max("at").alias("last")).withColumn("upto", upto("_part"))  # a row for each task
    fits = F.col("upto") <= budget
    kept = sums.agg(F.max(F.when(fits, F.col("last"))).alias("last"), F.max(F.when(fits, F.col("upto"))).alias("upto"), F.min(F.when(~fits, F.col("_part"))).alias("ends")).first()
    inside = ordered.where(F.col("_part") == F.lit(kept.ends)).groupBy("at").agg(F.sum("size").alias("n")).withColumn("upto", upto("at") + F.lit(kept.upto or 0))  # of one task
    reached = inside.where(F.col("upto") <= budget).agg(F.max("at")).first()[0]
    return next((x for x in (reached, kept.last) if x is not None), 0.0)


def take(queued: DataFrame, budget: int) -> DataFrame:
    """Adds copies, how often the mix takes the row, and taken, its words."""
    end = last_finish(sorted_items(queued), budget)
    copies = sum(((F.coalesce(finish(F.lit(i)), F.lit(2.0**62)) <= end).cast("int") for i in range(COPIES)), F.lit(0))
    return queued.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def op4_mixing(docs: DataFrame) -> DataFrame:
    rows = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    queued = settle(queue(rows))
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return take(queued, budget).select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), F.col("taken").cast("long").alias("taken"))


def schedule(queued: DataFrame, budget: int) -> DataFrame:
    """The mix in order: a row for each copy taken, range-sorted by finish time."""
    end = last_finish(sorted_items(queued), budget)
    items = queued.select("doc_id", "source", "size", F.posexplode(F.array(*(finish(F.lit(i)) for i in range(COPIES)))).alias("copy", "finish"))
    return items.where(F.col("finish") <= end).orderBy("finish", F.asc_nulls_last("source"), F.asc_nulls_last("doc_id"), "copy")


def place(doc_id, size):
    """Where a row stands in its source's queue."""
    return F.struct(shuffle_key(doc_id), doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), size)


def mix(docs: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it.

    What a source gives is all its rows some times over and once more those up to one place in its
    queue; so only a row for each source meets the texts. Sources without words stay as they are.
    """
    rows = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    taken = take(settle(queue(rows)), budget)
    last = place(F.col("doc_id"), F.col("size"))
    full = taken.groupBy("source").agg(F.min("copies").alias("_full"), F.max(F.struct("copies", last.alias("place"))).alias("_top"), F.max("source_size").alias("_n"))
    cuts = settle(full.withColumnRenamed("source", "_source"))
    more = (F.col("_top.copies") > F.col("_full")) & (F.col("_place") <= F.col("_top.place"))
    copies = F.when(F.col("_n") == 0, 1).otherwise(F.col("_full") + more.cast("int"))
    all_ = boxed(docs, "source", place(F.col("doc_id"), word_count(F.col("text"))).alias("_place"))
    found = all_.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_copies", copies)
    return unboxed(found.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))))


#: The same mix by plain windows over whole tables.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][1 + r % 3] AS BIGINT) AS weight, 3 * source_size AS cap FROM s),
f AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
         / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS lvl
  FROM w WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(lvl, (CAST(cap AS DOUBLE) / weight, source IS NULL, coalesce(source, ''))) AS lvl FROM f WHERE CAST(cap AS DOUBLE) / weight >= lvl),
t AS (SELECT w.source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT lvl FROM l)) AS target FROM w),
q AS (
  SELECT d.doc_id, d.size, d.source, t.source_size, coalesce(t.target, 0) AS target,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id NULLS LAST, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (SELECT size, CAST(e * source_size + upto AS DOUBLE) / target AS fin FROM q, (VALUES (0), (1), (2)) AS v(e) WHERE target > 0 AND size > 0),
c AS (SELECT fin, sum(size) OVER (ORDER BY fin RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent FROM i),
z AS (SELECT coalesce(max(fin), 0) AS cut FROM c WHERE spent <= (SELECT sum(size) FROM d))
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN target > 0 THEN size * (
         CAST(upto::DOUBLE / target <= cut AS INT) + CAST((source_size + upto)::DOUBLE / target <= cut AS INT) + CAST((2 * source_size + upto)::DOUBLE / target <= cut AS INT)) ELSE 0 END AS BIGINT) AS taken
FROM q, z
"""
