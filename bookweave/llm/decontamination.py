"""Benchmark decontamination by greedy string tiling.

Texts become words of letters and digits, A-Z folded, so punctuation and case don't hide a copy.
Running Karp-Rabin hashes of ``seed`` words that a document shares with a benchmark item make the pair
a candidate. Greedy tiling then marks the longest match of unmarked words again and again, each word
of the document and of the item at most once, until no match of ``seed`` words is left. The share of
the item's words under tiles is its coverage; order plays no part in it, so reordered passages count.
A document is contaminated by items of ``threshold`` coverage or more; only these are reported.

Matches are found as whole runs, never as all their seeds: a run starts where the words before it differ and
ends where the words after it do, and both are ranges of an index that is sorted by seed and by these
words. So n repeated words against m give n + m runs, not n * m seeds.

Null and empty texts match nothing; an item of fewer than ``seed`` words matches only as one whole run
of its words. Ties in length go to the earliest place in the item, then in the document; ties in
coverage to the least item_id. Equal rows get equal results; extra columns play no part or, in
``drop_contaminated``, pass through; either table may be empty.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookweave.llm import textkit
from bookweave.llm.common import boxed, carried, settle, unboxed

SEED, THRESHOLD = 4, 0.5
#: Benchmarks up to so many words travel to every task (8 bytes a word, and 32 of index in each worker); larger ones meet the documents by joins.
CARRIED = 4 << 20
#: Runs that are laid out at once for a share of a batch's documents.
RUNS = 1 << 21
#: Documents from which a seed counts as hot in the join, and into how many parts it is dealt.
HOT, SALT = 100_000, 32
TILES = "array<struct<doc:int,item:int,length:int>>"
HITS = f"array<struct<item_id:bigint,coverage:double,tiles:{TILES}>>"
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
WORDS = r"[0-9A-Za-z[^\x00-\x7F]]+"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = textkit.spans(BREAK[data], offsets)
    return textkit.hashes(textkit.FOLD[data], starts, ends), first


def tile(runs: list[tuple[int, int, int]], seed: int) -> list[tuple[int, int, int]]:
    """(place in doc, place in item, length) of the tiles; runs: all longest matches of ``seed`` words or more, in the same form."""
    low, high = min(r[0] for r in runs), max(r[0] + r[2] for r in runs)
    heap = [(-n, j, i - low) for i, j, n in runs]
    heapq.heapify(heap)
    in_doc, in_item, tiles = np.zeros(high - low, bool), np.zeros(max(r[1] + r[2] for r in runs), bool), []
    left = len(in_item)  # words of the item that may still be marked
    while heap and left >= seed:
        length, j, i = heapq.heappop(heap)
        free = ~(in_doc[i : i - length] | in_item[j : j - length])
        if free.all():
            tiles.append((i + low, j, -length))
            in_doc[i : i - length] = in_item[j : j - length] = True
            left += length
            continue
        edge = np.flatnonzero(np.diff(np.r_[False, free, False]))
        for a, b in edge.reshape(-1, 2).tolist():
            if b - a >= seed:
                heapq.heappush(heap, (a - b, j + a, i + a))
    return tiles


def _rolled(word: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, across documents too."""
    n = max(len(word) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += word[i : n + i] * textkit.STEP[i]
    return textkit.mix(out)


def _bound(values: np.ndarray, low: np.ndarray, high: np.ndarray, key: np.ndarray, right: bool) -> np.ndarray:
    """For each key, where it would stand in values[low:high], which are in order."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = values[np.minimum(middle, len(values) - 1)]
        after = open_ & ((at <= key) if right else (at < key))
        low, high = np.where(after, middle + 1, low), np.where(open_ & ~after, middle, high)
    return low


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges low to high - 1, and which range each is of."""
    n = high - low
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[of], of


class Benchmark:
    """An index of items, as sorted arrays: seeds of long items with the words before and after them, and short items whole."""

    def __init__(self, ids: list[int | None], word: np.ndarray, first: np.ndarray, seed: int = SEED):
        self.ids, self.seed, self.first, self.size = ids, seed, first, np.diff(first)
        item = np.repeat(np.arange(len(ids), dtype=np.int32), self.size)
        key = _rolled(word, seed)
        at = np.flatnonzero(item[: len(key)] == item[len(word) - len(key) :]) if len(key) else np.zeros(0, np.int64)
        key = key[at]
        before, after = np.r_[np.uint64(0), word][at], np.r_[word, np.uint64(0)][at + seed]
        before[at == first[item[at]]] = 0
        after[at + seed == first[item[at] + 1]] = 0
        self.sides = []
        for near in (before, after):
            order = np.lexsort((near, key))
            self.sides.append((near[order], at[order].astype(np.int32 if len(word) < 2**31 else np.int64)))
        self.keys = key[order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in range(1, seed):
            some = np.flatnonzero(self.size == k)
            if len(some):
                name = textkit.mix(sum(word[first[some] + i] * textkit.STEP[i] for i in range(k)))
                order = np.argsort(name, kind="stable")
                self.short[k] = name[order], some[order]

    @classmethod
    def of(cls, ids: list[int | None], texts: pa.Array | list[str | None], seed: int = SEED) -> Benchmark:
        return cls(ids, *_words(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts), seed)

    def runs(self, word: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        """Blocks of rows (document, item, place in the document, place in the item, length), all of a document and item in one block."""
        rolled = _rolled(word, self.seed)
        if not len(rolled) or not len(self.keys):
            return
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        at = np.flatnonzero(self.filter[(rolled >> np.uint64(44)).astype(np.int64)] & (doc[: len(rolled)] == doc[self.seed - 1 :]))
        low = np.searchsorted(self.keys, rolled[at])
        there = self.keys[np.minimum(low, len(self.keys) - 1)] == rolled[at]
        at, low = at[there], low[there]
        high = np.searchsorted(self.keys, rolled[at], "right")
        ends = []
        for (near, place), own in zip(self.sides, (at - 1, at + self.seed), strict=True):
            inside = (own >= 0) & (own < len(word))
            inside[inside] = doc[own[inside]] == doc[at[inside]]
            same = word[np.where(inside, own, 0)]
            left = np.where(inside, _bound(near, low, high, same, False), low)
            ends.append((place, left, np.where(inside, _bound(near, low, high, same, True), low)))
        load = np.zeros(len(first), np.int64)  # of each document, what lies before it
        np.add.at(load, doc[at] + 1, sum((left - low) + (high - right) for _, left, right in ends))
        load = np.cumsum(load)
        a = 0
        while a < len(first) - 1:
            b = max(a + 1, int(np.searchsorted(load, load[a] + RUNS, "right")) - 1)
            some = slice(*np.searchsorted(at, (first[a], first[b])))
            blocks = -(-int(load[b] - load[a]) // RUNS)
            for n in range(blocks):  # several only for one document that meets very many items
                cut = len(self.ids) * n // blocks, len(self.ids) * (n + 1) // blocks
                yield self._pairs(at[some], low[some], high[some], [(place, left[some], right[some]) for place, left, right in ends], doc, first, cut)
            a = b

    def _pairs(self, at, low, high, ends, doc, first, cut) -> np.ndarray:
        sorted_ = []
        for place, left, right in ends:
            parts = []
            for i in range(0, len(at), step := max(1, RUNS * len(at) // max(1, int(((left - low) + (high - right)).sum())))):
                part = slice(i, i + step)
                index, of = _spread(np.r_[low[part], right[part]], np.r_[left[part], high[part]])
                where, mine = place[index].astype(np.int64), np.tile(at[part], 2)[of]
                if cut != (0, len(self.ids)):
                    keep = (where >= self.first[cut[0]]) & (where < self.first[cut[1]])
                    where, mine = where[keep], mine[keep]
                parts.append((mine, where))
            mine, where = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
            order = np.lexsort((mine, mine - where))  # along diagonals, starts and ends take turns
            sorted_.append((mine[order], where[order]))
        (mine, where), (last, _) = sorted_
        item, d = np.searchsorted(self.first, where, "right") - 1, doc[mine]
        return np.column_stack([d, item, mine - first[d], where - self.first[item], last - mine + self.seed]) if len(mine) else np.zeros((0, 5), np.int64)

    def hits(self, column: pa.Array, threshold: float = THRESHOLD) -> list[list[dict]]:
        """For each text the items of ``threshold`` coverage or more, best first."""
        out: list[list[dict]] = []
        for _, _, data, offsets in textkit.runs(column):
            word, first = tokens(data, offsets)
            found: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
            for rows in self.runs(word, first):
                rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
                new = np.flatnonzero(np.r_[True, (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)]) if len(rows) else np.zeros(0, np.int64)
                most = np.add.reduceat(rows[:, 4], new) if len(new) else new
                for g in np.flatnonzero(most >= threshold * self.size[rows[new, 1]]).tolist():
                    part = rows[new[g] : new[g + 1] if g + 1 < len(new) else len(rows)]
                    self._add(found, int(part[0, 0]), int(part[0, 1]), tile(list(map(tuple, part[:, 2:].tolist())), self.seed), threshold)
            self._whole(word, first, found, threshold)
            out += [sorted(rows, key=lambda r: (-r["coverage"], r["item_id"] is not None, r["item_id"])) for rows in found]
        return out

    def _add(self, found: list, d: int, n: int, tiles: list[tuple[int, int, int]], threshold: float) -> None:
        coverage = sum(t[2] for t in tiles) / int(self.size[n])
        if coverage >= threshold:
            found[d].append({"item_id": self.ids[n], "coverage": coverage, "tiles": [dict(zip(("doc", "item", "length"), t, strict=True)) for t in sorted(tiles)]})

    def _whole(self, word: np.ndarray, first: np.ndarray, found: list, threshold: float) -> None:
        """Adds the short items, each by its first place."""
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for k, (names, items) in self.short.items():
            rolled = _rolled(word, k)
            at = np.flatnonzero(np.isin(rolled, names) & (doc[: len(rolled)] == doc[len(word) - len(rolled) :]))
            _, once = np.unique(np.stack([doc[at].astype(np.uint64), rolled[at]]), axis=1, return_index=True)
            for i in at[np.sort(once)].tolist():
                for n in items[np.searchsorted(names, rolled[i]) : np.searchsorted(names, rolled[i], "right")].tolist():
                    self._add(found, int(doc[i]), n, [(i - int(first[doc[i]]), 0, k)], threshold)


def _words(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and each text's first."""
    parts, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, data, offsets in textkit.runs(column):
        word, at = tokens(data, offsets)
        parts.append(word)
        first.append(at[1:] + first[-1][-1])
    return np.concatenate(parts), np.concatenate(first)


def with_hits(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, threshold: float = THRESHOLD, most: int = CARRIED) -> DataFrame:
    """Adds _hits to docs: the items that contaminate each, with coverage and tiles, best first. most: words up to which the benchmark travels."""
    bench = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    if (bench.agg(F.sum(F.regexp_count("text", F.lit(WORDS)))).first()[0] or 0) > most:
        return _joined(docs, settle(bench.distinct()), seed, threshold)
    rows = bench.distinct().orderBy("item_id", "text").toArrow()  # at most ``most`` words
    index = docs.sparkSession.sparkContext.broadcast((rows.column("item_id").to_pylist(), *_words(rows.column("text"))))
    name = uuid.uuid4().hex

    @F.arrow_udf(HITS)
    def hits(text: pa.Array) -> pa.Array:
        return pa.array(_index(name, index, seed).hits(text, threshold), _hit_type())

    return docs.withColumn("_hits", hits(F.col("text").cast("string")))


def _hit_type() -> pa.DataType:
    return pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", _tile_type())]))


def _tile_type() -> pa.DataType:
    return pa.list_(pa.struct([("doc", pa.int32()), ("item", pa.int32()), ("length", pa.int32())]))


_built: dict[tuple[str, int], Benchmark] = {}


def _index(name: str, variable: Broadcast, seed: int) -> Benchmark:
    """The index of a broadcast benchmark, built once in each worker process; name: unlike that of any other benchmark."""
    if (name, seed) not in _built:
        _built.clear()
        _built[name, seed] = Benchmark(*variable.value, seed)
    return _built[name, seed]


def item_seeds(items: DataFrame, seed: int, threshold: float) -> DataFrame:
    """items: _item, text. (_item, _seed): so many seeds of each item, rare ones first, that whatever it contaminates shares one.

    Tiles of ``seed`` words or more over the threshold's share of an item hold a seed for every ``seed`` words at least; so
    many places less one, the commonest in the benchmark, can be left out.
    """

    @F.arrow_udf("struct<n:bigint,seeds:array<struct<seed:bigint,places:bigint>>>")
    def seeds(text: pa.Array) -> pa.Array:
        out = []
        word, first = _words(text)
        for a, b in zip(first, first[1:], strict=False):
            k = min(seed, int(b - a))
            names, places = np.unique(_rolled(word[a:b], k), return_counts=True) if k else ([], [])
            out.append({"n": int(b - a), "seeds": [{"seed": s, "places": p} for s, p in zip(np.array(names, np.uint64).view(np.int64).tolist(), list(places), strict=True)]})
        return pa.array(out, pa.struct([("n", pa.int64()), ("seeds", pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.int64())])))]))

    rows = settle(items.select("_item", seeds("text").alias("s")).select("_item", "s.n", F.inline("s.seeds")).withColumnRenamed("seed", "_seed"))
    rows = rows.join(rows.groupBy("_seed").agg(F.count("*").alias("df")), "_seed")
    common_first = Window.partitionBy("_item").orderBy(F.desc("df"), "_seed").rowsBetween(Window.unboundedPreceding, 0)
    spare = F.when(F.col("n") < seed, 0).otherwise(F.ceil(F.ceil(F.col("n") * F.lit(float(threshold))) / seed) - 1)
    return rows.withColumn("gone", F.sum("places").over(common_first)).where(F.col("gone") > spare).select("_item", "_seed", "n")


def _joined(docs: DataFrame, bench: DataFrame, seed: int, threshold: float, hot: int = HOT) -> DataFrame:
    """The same by joins on seeds, for benchmarks of any size. A row holds one document and one item at a time."""
    items = settle(bench.withColumn("_item", F.md5(F.concat_ws(" ", "item_id", "text"))))
    right = settle(item_seeds(items, seed, threshold))
    lengths = [r[0] for r in right.select(F.least("n", F.lit(seed))).distinct().collect()]  # at most ``seed`` rows
    # one bit for each 26-bit prefix of a seed: 8 MB, whatever the size of the benchmark
    cells = right.groupBy(F.shiftrightunsigned("_seed", 44).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(shiftrightunsigned(_seed, 38) & 63 AS INT)))").alias("bits")).toArrow()
    bits = np.zeros(1 << 20, np.int64)
    bits[cells.column("at").to_numpy()] = cells.column("bits").to_numpy()
    known = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    @F.arrow_udf("array<bigint>")
    def seeds(text: pa.Array) -> pa.Array:
        out, table = [], known.value
        for _, _, data, offsets in textkit.runs(text):
            word, first = tokens(data, offsets)
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            found, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for k in lengths:
                rolled = _rolled(word, k)
                at = (table[(rolled >> np.uint64(44)).astype(np.int64)] >> ((rolled >> np.uint64(38)) & np.uint64(63))) & np.uint64(1)
                at = np.flatnonzero((at == 1) & (doc[: len(rolled)] == doc[len(word) - len(rolled) :]))
                found.append(rolled[at])
                of.append(doc[at])
            found, of = np.concatenate(found), np.concatenate(of)
            order = np.lexsort((found, of))
            found, of = found[order], of[order]
            new = np.r_[True, (np.diff(found.view(np.int64)) != 0) | (np.diff(of) != 0)][: len(found)]
            out += [x.view(np.int64).tolist() for x in np.split(found[new], np.searchsorted(of[new], np.arange(1, len(first) - 1)))]
        return pa.array(out, pa.list_(pa.int64()))

    key = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    left = settle(docs.select(key.alias("_key"), seeds(F.col("text").cast("string")).alias("_s")).select("_key", F.explode("_s").alias("_seed")))
    # seeds of very many documents are dealt into parts, and their items to each of these
    busy = carried(settle(left.groupBy("_seed").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("_seed", F.lit(True).alias("_hot"))))
    left = left.join(busy, "_seed", "left").withColumn("_part", F.when(F.col("_hot"), F.pmod(F.xxhash64("_key"), F.lit(SALT))).otherwise(0).cast("int"))
    right = right.join(busy, "_seed", "left").withColumn("_part", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))))
    pairs = settle(left.select("_key", "_seed", "_part").join(right.select("_item", "_seed", "_part"), ["_seed", "_part"]).select("_key", "_item").distinct())

    @F.arrow_udf(HITS)
    def tiled(text: pa.Array, item_id: pa.Array, item: pa.Array) -> pa.Array:
        out = []
        for i, n in enumerate(item_id.to_pylist()):
            out += Benchmark.of([n], item.slice(i, 1).cast(pa.large_string()), seed).hits(text.slice(i, 1), threshold)
        return pa.array(out, _hit_type())

    texts = docs.select(key.alias("_key"), F.col("text").cast("string").alias("_text")).join(pairs.select("_key").distinct(), "_key", "left_semi").dropDuplicates(["_key"])
    met = pairs.join(items, "_item").join(texts, "_key").select("_key", F.explode(tiled("_text", "item_id", "text")).alias("h"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("h.coverage")).alias("c"), "h")))
    met = settle(met.groupBy(F.col("_key").alias("_met")).agg(F.transform(ordered, lambda x: x["h"]).alias("_hits")))
    found = docs.withColumn("_key", key).join(carried(met), F.col("_key") == F.col("_met"), "left")
    return found.drop("_key", "_met").withColumn("_hits", F.coalesce("_hits", F.array().cast(HITS)))


def op6_decontamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: the items that contaminate it, the best of them and its coverage (0 where there is none)."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, threshold=threshold).drop("text")
    best = F.get("_hits", F.lit(0))
    return found.select("doc_id", (F.size("_hits") > 0).alias("contaminated"), F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"), best["item_id"].alias("item_id"), F.transform("_hits", lambda h: h["item_id"]).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that no item contaminates, with their columns."""
    return unboxed(with_hits(boxed(docs, "text"), benchmark, threshold=threshold).where(F.size("_hits") == 0))
