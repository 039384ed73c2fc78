"""Exact n-gram Jaccard join: all links between documents of like shingle sets, by signature trees.

A document's set holds the 64-bit hashes of its distinct word shingles (A-Z folded). Two documents link
when 100 * shared >= percent * union. Documents of equal sets form a class; the join runs between classes.

1. A class of n shingles can miss d(n) of them in any partner, so it offers its a(n) > d(n) least
   hashes; partners share at least s = a - d offers. Offers are counted over all classes, ordered from
   rare to common, and all but the s - 1 commonest kept; partners then share a kept offer. Offers of one
   class alone are dropped, so most documents end here and common passages seldom come further.
2. Classes that share kept offers, directly or through others, form a block.
3. In a block, classes become leaves of a signature tree, whose nodes hold OR-combined bitmaps of
   shingles and ranges of set size. A dual traversal prunes pairs of nodes whose greatest possible
   overlap is too small; the pairs left are counted exactly, but for those already connected.
   A block too large for one task is cut by set size and hash. Each part is joined in itself, then one
   class of each connected part of each; what is then the block's largest component needs no further
   joins in itself, and only the classes outside it meet each other and the rest, part by part.

Null and empty texts and texts without words have empty sets and link with nothing, not even each other.
A text of fewer words than a shingle has one shingle, of all its words. Equal rows share a class; rows of
one doc_id with unequal texts stay apart but share the id; a null id is less than any other and comes
back as null. Extra columns play no part or pass through ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookweave.llm import textkit
from bookweave.llm.common import boxed, carried, settle, unboxed
from bookweave.llm.graph import components

BITS, FAN = 4096, 8
#: Offers beyond those that a partner may lack.
SLACK = 96
#: Shingles that one task holds of a block (a class counts as LEAST at least, for its bitmap).
TASK_SHINGLES, LEAST = 1 << 20, 256
NO_ID = -(2**63)


def missing(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of n shingles a partner may lack."""
    return n - -(-percent * n // 100)


def offered(n: np.ndarray, percent: int) -> np.ndarray:
    """How many hashes a class of n offers: so many more than it can miss that common passages of some length can be left out."""
    d = missing(n, percent)
    return np.minimum(n, d + np.maximum(SLACK, d // 3))


def kept(n: np.ndarray, percent: int) -> np.ndarray:
    """How many offers, rare ones first, a class must keep to share one with each partner; the least partner offers the least."""
    small = -(-percent * n // 100)
    shared = np.minimum(offered(n, percent) - missing(n, percent), offered(small, percent) - missing(small, percent))
    return offered(n, percent) - np.maximum(shared, 1) + 1


def offered_sql(n: str, percent: int) -> str:
    d = f"({n} - (({percent} * {n} + 99) DIV 100))"
    return f"least({n}, {d} + greatest({SLACK}, {d} DIV 3))"


def kept_sql(percent: int) -> str:
    small = f"(({percent} * n + 99) DIV 100)"
    slack = lambda n: f"({offered_sql(n, percent)} - ({n} - (({percent} * {n} + 99) DIV 100)))"
    return f"{offered_sql('n', percent)} - greatest(least({slack('n')}, {slack(small)}), 1) + 1"


def sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The ordered distinct shingle hashes of each text."""
    for _, _, data, offsets in textkit.runs(column):
        sh, at = textkit.shingles(*textkit.words(data, offsets), words)
        for a, b in zip(at, at[1:], strict=False):
            yield np.unique(sh[a:b])


def identity(s: np.ndarray) -> int:
    """64 bits that stand for a set, with its size."""
    total = textkit.mix(s ^ textkit.STEP[40]).sum(keepdims=True) + np.array([len(s)], np.uint64) * textkit.STEP[41]
    return int(textkit.mix(total).view(np.int64)[0]) if len(s) else 0


def classed(text: Column, words: int) -> Column:
    """The class of each text, 0 where it has no words."""

    @F.arrow_udf("bigint")
    def named(text: pa.Array) -> pa.Array:
        return pa.array([identity(s) for s in sets(text, words)], pa.int64())

    return named(text.cast("string"))


def offers(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """id, n, c (the class) and low (its offers) of each document."""

    @F.arrow_udf("struct<n:int,c:bigint,low:array<bigint>>")
    def measured(text: pa.Array) -> pa.Array:
        n, c, low = [], [], []
        for s in sets(text, words):
            n.append(len(s))
            c.append(identity(s))
            low.append(s[: int(offered(np.int64(len(s)), percent))].view(np.int64))
        return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(c, pa.int64()), pa.array(low, pa.list_(pa.int64()))], ["n", "c", "low"])

    found = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), measured(F.col("text").cast("string")).alias("s"))
    return found.select("id", "s.n", "s.c", "s.low")


def shared_offers(classes: DataFrame, percent: int) -> DataFrame:
    """classes: c, n, low. (c, t): the kept offers that other classes have offered too."""

    rows = classes.select("c", "n", F.explode("low").alias("t"))
    counts = rows.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    common = rows.join(counts, "t")
    ranked = common.groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("o"))  # at most a(n) of one class
    common_only = F.expr(kept_sql(percent)) - (F.expr(offered_sql("n", percent)) - F.size("o"))  # offers of one class alone are the rarest
    ranked = ranked.withColumn("take", common_only.cast("int"))
    return ranked.where("take > 0").select("c", F.explode(F.slice("o", 1, F.col("take"))).alias("o")).select("c", F.col("o.t").alias("t"))


def blocks(kept_offers: DataFrame) -> DataFrame:
    """(c, block) of the classes that share kept offers with others, directly or through others."""
    kept_offers = settle(kept_offers)
    first = kept_offers.groupBy("t").agg(F.min("c").alias("m"))
    edges = kept_offers.join(first, "t").where("c <> m").select(F.col("c").alias("a"), F.col("m").alias("b"))
    return settle(components(edges).select(F.col("node").alias("c"), F.col("root").alias("block")))


class Tree:
    """A signature tree over sets in a given order: levels of bitmaps, size ranges and surplus (shingles beyond distinct bits)."""

    def __init__(self, items: list[np.ndarray]):
        n = np.array([len(s) for s in items])
        bits = np.zeros((len(items), BITS), bool)
        owner = np.repeat(np.arange(len(items)), n)
        bits[owner, (np.concatenate(items) >> np.uint64(20)).astype(np.int64) % BITS] = True
        maps = np.packbits(bits, axis=1).view(np.uint64)
        self.levels = [(maps, n, n, n - np.bitwise_count(maps).sum(1).astype(np.int64))]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, extra = self.levels[-1]
            at = np.arange(0, len(maps), FAN)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(extra, at)))

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether pairs of nodes may hold a link: by size, then by the greatest possible overlap."""
        maps, low, high, extra = self.levels[level]
        ok = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        for i in range(0, len(a), 4096):
            part = np.flatnonzero(ok[i : i + 4096]) + i
            x, y = a[part], b[part]
            most = np.bitwise_count(maps[x] & maps[y]).sum(1).astype(np.int64) + np.minimum(extra[x], extra[y])
            most = np.minimum(most, np.minimum(high[x], high[y]))
            ok[part] = 100 * most >= percent * (np.maximum(low[x], most) + np.maximum(low[y], most) - most)
        return ok

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of lowest nodes (a <= b) that the dual traversal leaves; lowest nodes hold FAN sets."""
        top = len(self.levels) - 1
        a = b = np.zeros(1, np.int64)
        for level in range(top - 1, 0, -1):
            size = len(self.levels[level][0])
            grid = np.arange(FAN)
            a, b = (np.add.outer(a * FAN, np.repeat(grid, FAN)).ravel(), np.add.outer(b * FAN, np.tile(grid, FAN)).ravel())
            inside = (a <= b) & (a < size) & (b < size)
            a, b = a[inside], b[inside]
            ok = self.may_link(level, a, b, percent) | (a == b)
            a, b = a[ok], b[ok]
        return a, b


def join_block(items: list[np.ndarray], percent: int, halves: np.ndarray | None = None, start: np.ndarray | None = None) -> np.ndarray:
    """The least position that each set of a block is connected to by links. halves: join only sets of unequal halves. start: sets of equal value are connected already."""
    n = np.array([len(s) for s in items])
    order = np.lexsort((n, [int(s[0]) for s in items])) if len(items) > FAN else np.arange(len(items))
    items, sized = [items[i] for i in order], n[order]
    label = np.arange(len(items))
    if start is not None:
        _, first, known = np.unique(start[order], return_index=True, return_inverse=True)
        label = first[known]
    side = halves[order] if halves is not None else None
    names, dense = np.unique(np.concatenate(items), return_inverse=True)
    at = np.r_[0, np.cumsum(sized)]
    mark = np.zeros(len(names), np.int32)
    tree = Tree(items) if len(items) > FAN else None
    first, second = tree.pairs(percent) if tree else (np.zeros(1, np.int64), np.zeros(1, np.int64))
    by = np.argsort(first, kind="stable")
    first, second = first[by], second[by]
    for node in np.unique(first):
        partners = second[np.searchsorted(first, node) : np.searchsorted(first, node, "right")]
        others = (partners[:, None] * FAN + np.arange(FAN)).ravel()
        others = others[others < len(items)]
        for i in range(node * FAN, min(len(items), (node + 1) * FAN)):
            j = others[(others > i) & (label[others] != label[i])]
            j = j[(100 * sized[j] >= percent * sized[i]) & (100 * sized[i] >= percent * sized[j])]
            if side is not None:
                j = j[side[j] != side[i]]
            if tree is not None and len(j):
                j = j[tree.may_link(0, np.full(len(j), i), j, percent)]
            if not len(j):
                continue
            mark[dense[at[i] : at[i + 1]]] = 1
            where = np.repeat(at[j] - np.r_[0, np.cumsum(sized[j])[:-1]], sized[j]) + np.arange(sized[j].sum())
            shared = np.add.reduceat(mark[dense[where]], np.r_[0, np.cumsum(sized[j])[:-1]])
            mark[dense[at[i] : at[i + 1]]] = 0
            linked = j[100 * shared >= percent * (sized[i] + sized[j] - shared)]
            if len(linked):
                together = np.unique(np.r_[label[linked], label[i]])
                label[np.isin(label, together)] = together[0]
    out = np.empty(len(items), np.int64)
    least: dict[int, int] = {}
    for place, i in enumerate(order):
        least[label[place]] = min(least.get(label[place], i), i)
    for place, i in enumerate(order):
        out[i] = least[label[place]]
    return out


def load() -> Column:
    """What a class takes of a task."""
    return F.sum(F.greatest("n", F.lit(LEAST)))


def cut(rows: DataFrame, percent: int, task: int) -> DataFrame:
    """rows: c, n, block. Adds level (sizes of links differ by one at most), k (parts of the block's level) and i (the row's part)."""
    unit = max(float(np.log(100 / percent)) * 1.0001, 1e-6)
    rows = rows.withColumn("level", F.floor(F.log(F.col("n").cast("double")) / F.lit(unit)).cast("int"))
    width = rows.groupBy("block", "level").agg(F.ceil(load() * 2 / task).cast("int").alias("k"))
    return rows.join(width, ["block", "level"]).withColumn("i", F.pmod(F.xxhash64("c", F.lit(5)), F.col("k")).cast("int"))


def _job(kind: str, *names: Column | str) -> Column:
    return F.concat_ws("/", F.lit(kind), F.col("block").cast("string"), *names)


def _facing(rows: DataFrame, others: DataFrame) -> DataFrame:
    """rows, once for each part (level2, j) of others that may hold partners by size."""
    width = others.groupBy("block", F.col("level").alias("level2")).agg(F.max("k").alias("k2"))
    near = rows.withColumn("level2", F.explode(F.array(*(F.col("level") + d for d in (-1, 0, 1)))))
    return near.join(width, ["block", "level2"]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k2") - 1)))


def crossing(rest: DataFrame, main: DataFrame) -> DataFrame:
    """(c, job, half): the jobs in which parts of rest meet each other, and parts of main; half null: join all."""
    met = _facing(rest, rest)
    own, other = F.struct("level", "i"), F.struct("level2", "j")
    key = F.when(own <= other, _job("r", "level", "i", "level2", "j")).otherwise(_job("r", "level2", "j", "level", "i"))
    half = F.when(own < other, 0).when(own > other, 1)
    out = met.select("c", key.alias("job"), half.alias("half"))
    out = out.union(_facing(rest, main).select("c", _job("m", "level", "i", "level2", "j").alias("job"), F.lit(0).alias("half")))
    return out.union(_facing(main, rest).select("c", _job("m", "level2", "j", "level", "i").alias("job"), F.lit(1).alias("half")))


def links(docs: DataFrame, members: DataFrame, jobs: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): edges that connect the classes of each job as all its links do. members: c, id (a document of the class), root (what is connected already). jobs: c, job, half."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    wanted = settle(members.select("c", "id", "root").join(jobs, "c").groupBy("id", "c", "root").agg(F.collect_list(F.struct("job", "half")).alias("jobs")))
    found = texts.join(carried(wanted), "id").select(F.explode("jobs").alias("j"), "c", "root", "text").select("j.job", "j.half", "c", "root", "text")
    found = found.repartition("job").sortWithinPartitions("job")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, held = None, {}
        for batch in batches:
            names, halves, classes, roots = (batch.column(i).to_pylist() for i in range(4))
            edges: list[tuple[int, int]] = []
            for name, half, c, root, s in zip(names, halves, classes, roots, sets(batch.column(4), words), strict=True):
                if name != job:
                    edges += finish(held)
                    job, held = name, {}
                if identity(s) == c:  # else another text of the same doc_id
                    held[c] = (half, root, s)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], schema=schema)
        edges = finish(held)
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], schema=schema)

    def finish(held: dict) -> list[tuple[int, int]]:
        if len(held) < 2:
            return []
        classes = sorted(held)
        halves = np.array([held[c][0] for c in classes]) if held[classes[0]][0] is not None else None
        root = join_block([held[c][2] for c in classes], percent, halves, np.array([held[c][1] for c in classes]))
        return [(classes[i], classes[r]) for i, r in enumerate(root.tolist()) if i != r]

    return settle(found.mapInArrow(joined, "a long, b long"))


def connected(docs: DataFrame, members: DataFrame, words: int, percent: int, task: int) -> DataFrame:
    """members: c, n, id, block. (node, root) of all classes that links connect to others."""

    def with_root(edges: DataFrame) -> DataFrame:
        roots = components(edges)
        return settle(members.join(roots, members["c"] == roots["node"], "left").select("c", "n", "id", "block", F.coalesce("root", "c").alias("root")))

    weights = members.groupBy("block").agg(load().alias("w"))
    heavy = settle(weights.where(F.col("w") > task).select("block"))
    no_half = F.lit(None).cast("int").alias("half")
    alone = members.withColumn("root", F.col("c"))
    small = members.join(heavy, "block", "left_anti").select("c", _job("b").alias("job"), no_half)
    if heavy.isEmpty():
        return components(links(docs, alone, small, words, percent))
    large = settle(cut(members.join(heavy, "block"), percent, task))
    edges = links(docs, alone, small.union(large.select("c", _job("p", "level", "i").alias("job"), no_half)), words, percent)
    rooted = with_root(edges)
    heads = large.join(rooted.select("c", "root"), "c").groupBy("block", "level", "i", "root").agg(F.min(F.struct("c", "n")).alias("h")).select("block", "h.c", "h.n")
    few = heads.groupBy("block").agg(load().alias("w")).where(F.col("w") <= task).select("block")
    edges = settle(edges.union(links(docs, rooted, heads.join(few, "block").select("c", _job("h").alias("job"), no_half), words, percent)))
    rooted = with_root(edges)
    split = rooted.join(heavy, "block")
    most = split.groupBy("block", "root").agg(F.sum("n").alias("w")).groupBy("block").agg(F.max_by("root", F.struct("w", "root")).alias("main"))
    split = settle(split.join(most, "block"))
    rest, main = (settle(cut(split.where(x).select("c", "n", "block"), percent, task)) for x in ("root <> main", "root = main"))
    return components(edges.union(links(docs, rooted, crossing(rest, main), words, percent)))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, task: int = TASK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links) of each document."""
    return _named(_components(docs, words, percent, task))


def _components(docs: DataFrame, words: int, percent: int, task: int) -> DataFrame:
    """id, n, component (the least id reachable by links), c and root (the class that stands for the component) of each document."""
    all_ = settle(offers(docs, words, percent))
    classes = settle(all_.where("n > 0").groupBy("c", "n").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    repeated = classes.where("copies > 1").select("c")
    repeated = carried(repeated)
    others = all_.where("n > 0").join(repeated, "c", "left_anti").select("c", "n", "low")
    copied = all_.where("n > 0").join(repeated, "c", "left_semi").groupBy("c", "n").agg(F.first("low").alias("low"))
    found = blocks(shared_offers(others.union(copied), percent))
    members = settle(classes.join(found, "c").select("c", "n", "id", "block"))
    roots = settle(connected(docs, members, words, percent, task))
    homes = classes.join(roots, classes["c"] == roots["node"], "left").select("c", "n", "id", F.coalesce("root", "c").alias("root"))
    least = homes.groupBy("root").agg(F.min("id").alias("component"))
    homes = homes.join(least, "root").select("c", F.col("n").alias("_n"), "component", "root")
    linked = all_.where("n > 0").select("id", "n", "c").join(homes, "c").where("n = _n").select("id", "n", "component", "c", "root")
    return linked.union(all_.where("n = 0").select("id", "n", F.col("id"), "c", "c"))


def _named(found: DataFrame) -> DataFrame:
    real = lambda name: F.when(F.col(name) != NO_ID, F.col(name))
    return found.select(real("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), real("component").alias("component_id"))


def op8_jaccard(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=4, percent=85)


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but one (of least doc_id, then of least class) of each group that links connect; rows without words all stay."""
    found = settle(_components(docs, words, percent, TASK_SHINGLES))
    some = found.where("n > 0").select("id", "c", "root")
    heads = some.groupBy("root").agg(F.min(F.struct("id", "c")).alias("h")).select("h.*")
    lost = settle(some.select("id", "c").distinct().join(heads, ["id", "c"], "left_anti"))
    several = settle(found.where(F.col("id") != NO_ID).groupBy("id").count().where("count > 1").select("id"))
    lost, several = carried(lost), carried(several)
    rows = boxed(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    known = rows.where(F.col("id") != NO_ID)
    stay = known.join(several, "id", "left_anti").join(lost, "id", "left_anti").select("_row")
    # where an id does not tell the row, its class does
    unsure = rows.where(F.col("id") == NO_ID).union(known.join(several, "id", "left_semi").select("_row", "id", "text"))
    unsure = unsure.select("_row", "id", classed(F.col("text"), words).alias("c")).join(lost, ["id", "c"], "left_anti")
    twice = carried(settle(some.groupBy("id", "c").count().where("count > 1").select("id", "c")))
    single = unsure.join(twice, ["id", "c"], "left_anti").select("_row")
    double = unsure.join(twice, ["id", "c"], "left_semi").dropDuplicates(["id", "c"]).select("_row")
    return unboxed(stay.union(single).union(double))


#: The same by an inverted index of all shingles and reachability, for tables with doc_ids.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS sh FROM d),
k AS (SELECT doc_id, len(sh) AS n, sh, md5(array_to_string(sh, chr(31))) AS c FROM s),
g AS (SELECT c, min(doc_id) AS least, any_value(sh) AS sh FROM k WHERE n > 0 GROUP BY c),
x AS (SELECT c, len(sh) AS n, unnest(sh) AS t FROM g),
p AS (SELECT a.c AS a, b.c AS b FROM x a JOIN x b ON a.t = b.t AND a.c < b.c GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(c, o) AS (SELECT c, c FROM g UNION SELECT r.c, e.b FROM r JOIN e ON r.o = e.a),
h AS (SELECT r.c, min(g.least) AS least FROM r JOIN g ON r.o = g.c GROUP BY r.c)
SELECT doc_id, n AS n_shingles, coalesce(least, doc_id) AS component_id FROM k LEFT JOIN h ON k.c = h.c AND n > 0
"""
