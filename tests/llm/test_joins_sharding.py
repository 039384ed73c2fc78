"""Jaccard join, decontamination, sharding and components against brute force."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookweave.llm import common, decontamination, graph, jaccard, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, _hits string, id string, c string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", None, *["clash"] * 5) for i, t in rows], DOCS)


def shingle_set(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\xa0", "§").split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(sets, percent):
    """Least position reachable, by looking at all pairs."""
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def corpus(seed, n=260):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(50)]
    out = []
    while len(out) < n:
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8, 20, 60, 150]))]
        if rng.random() < 0.4:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 1, 2, 5, 12])):
            edit = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if edit:
                    at = rng.randrange(len(edit))
                    edit[at : at + rng.randrange(2)] = [rng.choice(words)]
            out.append(" ".join(edit).title() if rng.random() < 0.2 else "  ".join(edit))
    return out[:n]


@pytest.mark.parametrize(("seed", "words", "percent", "task"), [(1, 4, 85, 1 << 22), (2, 5, 80, 1 << 22), (3, 4, 85, 9000), (5, 4, 85, 2000), (6, 5, 80, 30_000)])
def test_jaccard_join_against_all_pairs(spark, seed, words, percent, task):
    texts = [*corpus(seed), None, "", " \n", "é ü"]
    root = groups([shingle_set(t, words) for t in texts], percent)
    docs = frame(spark, enumerate(texts)).repartition(3)
    got = {r.doc_id: r for r in jaccard.near_duplicates(docs, words, percent, task).collect()}
    assert {i: got[i].component_id for i in got} == dict(enumerate(root))
    assert all(got[i].n_shingles == len(shingle_set(t, words)) for i, t in enumerate(texts))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([50, 80, 85, 100]), st.booleans())
def test_tree_join_of_a_block(seed, percent, split):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, 120, dtype=np.uint64)
    items = []
    for _ in range(int(rng.integers(2, 60))):
        if items and rng.random() < 0.7:
            new = np.unique(np.r_[rng.choice(items[rng.integers(len(items))], 30), rng.choice(pool, rng.integers(1, 6))])
        else:
            new = np.unique(rng.choice(pool, rng.integers(1, 60)))
        items.append(new)
    halves = rng.integers(0, 2, len(items)) if split else None
    got = jaccard.join_block(items, percent, halves).tolist()
    root = list(range(len(items)))
    for i, a in enumerate(items):
        for j in range(i):
            both = len(np.intersect1d(a, items[j]))
            if (halves is None or halves[i] != halves[j]) and 100 * both >= percent * (len(a) + len(items[j]) - both):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert got == root


def test_kept_offers_are_enough():
    """Whatever a partner lacks, and whatever the order, partners share a kept offer."""
    n = np.arange(1, 3000)
    for percent in (50, 80, 85, 99):
        d, a, k = jaccard.missing(n, percent), jaccard.offered(n, percent), jaccard.kept(n, percent)
        assert (a > d).all() and (k >= 1).all() and (k <= a).all()
        slack = a - k  # offers that may be left out
        for size in (1, 5, 40, 999):
            small = -(-percent * size // 100)
            for other in range(small, size + 1):
                shared = min(a[size - 1] - d[size - 1], a[other - 1] - d[other - 1])
                assert shared > slack[size - 1] and shared > slack[other - 1]


def test_bounds_in_sql(spark):
    for percent in (50, 80, 85, 100):
        rows = spark.range(1, 3000).selectExpr("CAST(id AS INT) AS n").selectExpr("n", f"{jaccard.offered_sql('n', percent)} AS o", f"{jaccard.kept_sql(percent)} AS k").orderBy("n").collect()
        n = np.arange(1, 3000)
        assert [r.o for r in rows] == jaccard.offered(n, percent).tolist() and [r.k for r in rows] == jaccard.kept(n, percent).tolist()


def test_jaccard_of_odd_tables(spark):
    assert jaccard.op8_jaccard(frame(spark, [])).collect() == []
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "other words in this text"), (7, "a b c d e"), (9, None), (8, "x " * 30_000)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op8_jaccard(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 2, None), (5, 2, None), (None, 2, None), (7, 2, 7), (7, 2, None), (9, 0, 9), (8, 1, 8)], key=str)


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    texts = corpus(4, 120)
    root = groups([shingle_set(t, 5) for t in texts], 80)
    docs = frame(spark, [*enumerate(texts), (0, texts[0])])
    out = jaccard.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    empty = [i for i, t in enumerate(texts) if not t.split()]
    assert sorted(r.doc_id for r in out.collect()) == sorted([*{*root, *empty}, *([] if texts[0].split() else [0])])


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_components_of_long_chains(spark, small):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (200, 200), (7, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long"), small=small).collect()}
    assert got == {**{i: 0 for i in range(61)}, 300: 0, 100: 100, 101: 100, 103: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long"), small=small).collect() == []


def plain_tiles(doc, item, seed):
    """Greedy string tiling as first written down: scan for the longest match, mark, repeat."""
    a, b, out = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < seed:
            return out
        out.append((i, j, k))
        a[i : i + k] = b[j : j + k] = [True] * k


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=24), st.lists(st.sampled_from("abc"), min_size=1, max_size=12), st.integers(2, 4))
def test_tiles_against_plain_tiling(doc, item, seed):
    bench = decontamination.Benchmark.of([1], [" ".join(item)], seed)
    hits = bench.hits(pa.array([" ".join(doc)]), 0.0)[0]
    want = plain_tiles(doc, item, min(seed, len(item)))[: None if len(item) >= seed else 1]
    assert sorted((t["doc"], t["item"], t["length"]) for h in hits for t in h["tiles"]) == sorted(want)


@pytest.mark.parametrize("runs", [1 << 21, 7])
def test_tiles_of_many_items_in_blocks(runs, monkeypatch):
    """The blocks that runs are laid out in change nothing."""
    monkeypatch.setattr(decontamination, "RUNS", runs)
    rng = random.Random(8)
    word = lambda n: [rng.choice("aab cde".replace(" ", "")) for _ in range(n)]
    items, docs = [word(rng.randrange(1, 14)) for _ in range(25)], [word(rng.randrange(0, 40)) for _ in range(12)]
    got = decontamination.Benchmark.of(list(range(25)), [" ".join(i) for i in items]).hits(pa.array([" ".join(d) for d in docs]), 0.5)
    for d, hits in zip(docs, got, strict=True):
        covered = {n: sum(t[2] for t in plain_tiles(d, i, min(4, len(i)))[: None if len(i) >= 4 else 1]) / len(i) for n, i in enumerate(items)}
        assert {h["item_id"]: h["coverage"] for h in hits} == {n: c for n, c in covered.items() if c >= 0.5}


def test_repeated_words_make_runs_not_pairs():
    began = time.perf_counter()
    hits = decontamination.Benchmark.of([1], ["w " * 1_600]).hits(pa.array(["w " * 8_000, "w " * 30, "w"]))
    assert [len(h) for h in hits] == [1, 0, 0] and hits[0][0]["coverage"] == 1.0 and time.perf_counter() - began < 1


def test_decontamination_paths_agree(spark):
    """Benchmarks that travel and those that are joined, hot seeds in one part and in many."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = spark.createDataFrame([(i, text(rng.choice([2, 3, 5, 9, 16, 30]))) for i in range(80)] + [(5, None), (80, "")], "item_id long, text string")
    docs = frame(spark, enumerate([text(rng.choice([0, 3, 30, 200])) for _ in range(60)] + [None, "v1 v2 " * 3_000])).drop("_hits")
    rows = lambda df: sorted((r.doc_id, [(h.item_id, round(h.coverage, 9), h.tiles) for h in r._hits]) for r in df.collect())
    travelled = rows(decontamination.with_hits(docs, bench))
    assert travelled == rows(decontamination.with_hits(docs, bench, most=0)) and sum(len(h) for _, h in travelled) > 100
    assert travelled == rows(decontamination._joined(docs, bench.where("text IS NOT NULL").distinct(), 4, 0.5, hot=3))


ITEM = "one two three four five six. Seven eight nine ten eleven twelve thirteen, fourteen fifteen sixteen"
CASES = [
    ("x y z " + ITEM.upper() + " tail", True),
    ("seven-eight nine ten eleven twelve thirteen fourteen fifteen sixteen filler one two three four five six", True),
    ("one two three four five six and nothing else here", False),
    ("one one two two three three four four", False),
    (None, False), ("", False), ("tiny item", True), ("a tiny, item b", True), ("tiny", False), ("q " * 40_000, False),
]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_decontamination_both_ways(spark, most):
    bench = spark.createDataFrame([(1, ITEM, "x"), (2, "Tiny item", "x"), (3, None, "x"), (4, "", "x"), (1, ITEM, "y")], "item_id long, text string, _hits string")
    docs = frame(spark, [*enumerate(t for t, _ in CASES), (0, CASES[0][0])])
    found = decontamination.with_hits(docs.drop("_hits"), bench, most=most).collect()
    assert len(found) == len(CASES) + 1
    for r in found:
        assert any(h.coverage >= 0.5 for h in r._hits) == CASES[r.doc_id][1]
    first = next(r for r in found if r.doc_id == 1)
    assert first._hits[0].coverage == 1.0 and len(first._hits[0].tiles) == 2


def test_each_benchmark_has_its_own_index(spark):
    """Workers outlive queries; what one query built must not serve the next."""
    docs = frame(spark, [(i, f"alpha beta gamma delta number {i}") for i in range(12)]).repartition(4)
    for i in range(12):
        bench = spark.createDataFrame([(i, f"gamma delta number {i}")], "item_id long, text string")
        assert [r.doc_id for r in decontamination.op6_decontamination(docs, bench).where("contaminated").collect()] == [i]


def test_decontamination_rows_and_filter(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "Tiny item")], "item_id long, text string")
    docs = frame(spark, enumerate(t for t, _ in CASES))
    rows = {r.doc_id: r for r in decontamination.op6_decontamination(docs, bench).collect()}
    assert {i: r.contaminated for i, r in rows.items()} == {i: bad for i, (_, bad) in enumerate(CASES)}
    assert rows[0]["items"] == [1] and rows[6]["item_id"] == 2 and rows[4].coverage == 0.0
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, bad) in enumerate(CASES) if not bad}
    assert decontamination.op6_decontamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.op6_decontamination(docs.limit(0), bench).collect() == []


def test_shards_are_even_and_keep_copies_together(spark):
    rng = random.Random(2)
    texts = [" ".join("word" for _ in range(rng.randrange(1, 200))) + f" {rng.randrange(400)}" for _ in range(900)] + [None, "", "é" * 20_000]
    docs = frame(spark, enumerate(texts))
    got = sharding.op5_sharding(docs).collect()
    size = Counter()
    for r in got:
        t = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None)
        size[r.shard] += r["size"]
    mean = sum(size.values()) / 8
    assert set(size) == set(range(8)) and all(abs(s - mean) < 0.05 * mean + 20_000 * (max(size.values()) == s) for s in size.values())
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    homes = {}
    assert all(homes.setdefault(texts[r.doc_id] or "", r.shard) == r.shard for r in got)
    again = sharding.op5_sharding(docs.repartition(5)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_of_odd_tables(spark):
    assert sharding.op5_sharding(frame(spark, [])).collect() == []
    same = sharding.op5_sharding(frame(spark, [(1, "x")] * 5 + [(None, "x")])).collect()
    assert len({r.shard for r in same}) == 1 and sorted(r.slot for r in same) == list(range(6))
    docs = frame(spark, [(i, f"text {i} " * 50) for i in range(64)])
    out = sharding.shard_documents(docs, target_bytes=8_000)
    assert out.columns[:-1] == [c for c in docs.columns if c != "shard"] and out.count() == 64
    weights = Counter()
    for r in out.collect():
        weights[r.shard] += len(r.text) + 1
    assert len(weights) == -(-sum(weights.values()) // 8_000) and max(weights.values()) < 10_000


def test_near_duplicates_are_dropped_by_row_not_by_id(spark):
    text = lambda k, n=40: " ".join(f"w{k}x{i}" for i in range(n))
    near = text("near")
    rows = [
        *((None, text(f"null{k}")) for k in range(5)), (None, text("null0")), (None, ""), (None, None), (None, ""),
        (1, near), (2, near + " more"), (2, text("own")), (3, text("a")), (3, text("b")), (3, text("b")), (4, ""), (4, ""), (4, text("c")),
    ]
    out = jaccard.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [*((None, text(f"null{k}")) for k in range(5)), (None, ""), (None, None), (None, ""), (1, near), (2, text("own")), (3, text("a")), (3, text("b")), (4, ""), (4, ""), (4, text("c"))]
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, want))


def plain_shards(rows, shards):
    """rows: (doc_id, text, source, lang). The shard of each text, by recursion over sorted lists."""
    groups = {}
    for i, t, source, lang in rows:
        groups.setdefault(t or "", []).append((i, source, lang))
    least = lambda values: min((v for v in values if v is not None), default=None)
    found = {t: (len(t.encode()) + 1, least(x[1] for x in g), least(x[2] for x in g), least(x[0] for x in g) or 0) for t, g in groups.items()}
    rank = lambda k: {v: n for n, v in enumerate(sorted({f[k] for f in found.values() if f[k] is not None}, key=lambda v: v.encode()), 1)} | {None: 0}
    sources, langs = rank(1), rank(2)
    units = [(t, (len(t.encode()) + 1) * len(groups[t]), (f[0], sources[f[1]], langs[f[2]], f[3]), hashlib.md5(t.encode()).hexdigest()) for t, f in found.items()]
    span = lambda part, k: float(max(u[2][k] for u in part)) - float(min(u[2][k] for u in part))
    whole = [span(units, k) for k in range(4)] if units else []
    homes = {}

    def split(part, first, count):
        if count == 1 or not part:
            homes.update({u[0]: first for u in part})
            return
        width = [span(part, k) / whole[k] if whole[k] else 0.0 for k in range(4)]
        dim, total, upto, sides = width.index(max(width)), sum(u[1] for u in part), 0, ([], [])
        for u in sorted(part, key=lambda u: (u[2][dim], u[3])):
            upto += u[1]
            sides[(2 * upto - u[1]) / 2 > total * (count // 2) / count].append(u)
        split(sides[0], first, count // 2)
        split(sides[1], first + count // 2, count - count // 2)

    split(units, 0, shards)
    return homes


@pytest.mark.parametrize("shards", [1, 2, 7, 8, 1_300])
def test_shards_against_a_plain_tree(spark, shards):
    """Sources that share a long prefix, nulls, copies, extreme ids, and more nodes than rows of any list."""
    rng = random.Random(shards)
    texts = [None, "", *(" ".join(rng.choice("abcdé") * rng.randrange(1, 9) for _ in range(rng.randrange(1, 60))) for _ in range(1_500))]
    rows = [(rng.choice([None, i, i, i]), t, rng.choice([None, *(f"wikipedia-long-name-{x}" for x in ("de", "en", "fr", "é"))]), rng.choice([None, "de", "en"])) for i, t in enumerate(texts + texts[:300])]
    rows += [(-(2**63), "least id", "a", "b"), (2**63 - 1, "greatest id", "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(5)
    got = sharding.shard_documents(docs, shards=shards).collect()
    homes = plain_shards(rows, shards)
    assert len(got) == len(rows) and all(r.shard == homes[r.text or ""] for r in got)


def test_running_sums_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.randrange(50), i, rng.randrange(1, 9)) for i in range(3_000)]
    got = sharding.running(spark.createDataFrame(rows, "g int, v long, i long, w long").repartition(7), "g", [F.col("v"), F.col("i")], "w").collect()
    upto, want = Counter(), {}
    for g, _, i, w in sorted(rows):
        upto[g] += w
        want[i] = upto[g]
    assert {r.i: r.upto for r in got} == want


def test_carried_tables_and_joined_ones_agree(spark, monkeypatch):
    """What travels to all tasks changes no result of the Jaccard join and of the filter."""
    texts = corpus(11, 90)
    docs = frame(spark, [*enumerate(texts), (None, texts[5]), (7, "quite another text here")])
    both = lambda: (sorted(map(str, jaccard.near_duplicates(docs, 5, 80, 9_000).collect())), sorted(map(str, jaccard.drop_near_duplicates(docs).collect())), sorted(map(str, sharding.op5_sharding(docs).collect())))
    carried = both()
    monkeypatch.setattr(common, "CARRIED", -1)
    assert both() == carried
