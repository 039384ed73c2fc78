"""Fingerprints and mixing against plain Python."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bookweave.llm import fingerprints, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, part string, halo string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "clash", "clash", "clash") for i, t, s in rows], DOCS)


def shingle_sets(t):
    w = "".join(c.lower() if c.isascii() else c for c in t).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_fingerprints_against_plain_order_and_sets(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, n)) for n in (0, 1, 3, 40, 700, 700, 900, 2500)]
    texts += [texts[4], texts[4] + " more words here", None, "é ü ß " * 300]
    rows = [(i * 7 % 13, t, "s") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprints.fingerprint_pairs(frame(spark, rows), 4).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(got) == len(rows)
    for (i, t, _), (_, u, _) in zip(order, [*order[1:], order[0]], strict=True):
        t, u = t or "", u or ""
        half = len(t) // 2
        new = t[: len(t) - half] + u[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        for near, other in ((got[i].near_edited, new), (got[i].near_next, u)):
            a, b = shingle_sets(t), shingle_sets(other)
            want = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - want) < 0.12
    assert len({got[i].fingerprint for i, t, _ in rows if t == texts[4]}) == 1


def test_fingerprints_of_ties_null_ids_and_few_rows(spark):
    rows = [(5, "b", "s"), (5, "a", "s"), (5, "a", "s"), (None, "x y", "s"), (9, None, "s")]
    out = fingerprints.fingerprint_pairs(frame(spark, rows), 3).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in out) == [(-1, 3), (5, 1), (5, 1), (5, 1), (9, 0)]
    one = fingerprints.fingerprint_pairs(frame(spark, [(1, "abc def", "s")]), 3).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abc abc").hexdigest()
    assert fingerprints.fingerprint_pairs(frame(spark, []), 3).collect() == []


def test_densified_bins_estimate_small_sets():
    texts = [f"a{i} b c d e f{i % 2}" for i in range(40)]
    f = fingerprints.fingerprints(pa.array(texts))
    got = [fingerprints.likeness(f[i : i + 1], f[j : j + 1])[0] for i in range(40) for j in range(i)]
    want = [len(shingle_sets(texts[i]) & shingle_sets(texts[j])) / len(shingle_sets(texts[i]) | shingle_sets(texts[j])) for i in range(40) for j in range(i)]
    assert abs(np.mean(got) - np.mean(want)) < 0.05


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    cap, target, open_, left = {s: 3 * sizes[s] for s in names}, {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if cap[s] < weight[s] * level}
        for s in full or open_:
            target[s] = cap[s] if full else weight[s] * level
        if not full:
            break
        left -= sum(cap[s] for s in full)
        open_ -= full
    return target


def test_mixing_reaches_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(1, 60)), ["a", "b", "c", "d", None][min(4, int(rng.exponential(1)))]) for i in range(900)]
    rows += [(1000, None, "a"), (1001, " ", "zero"), (1002, "", "zero"), (3, "w w", "a"), (3, "w w", "a"), (None, "w " * 9, "b")]
    docs = frame(spark, rows).repartition(5)
    got = mixing.op4_mixing(docs).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.op4_mixing(docs.repartition(2)).collect()), key=str)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, by = plain_targets(sizes), {s: i for i, (_, _, s) in enumerate(rows)}
    taken = mixing.op4_mixing(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert by and sorted(round(r.target, 6) for r in taken) == sorted(round(x, 6) for x in want.values())
    assert all(abs(r.taken - r.target) <= 120 for r in taken) and sum(r.taken for r in taken) <= sum(sizes.values())
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)


def test_mix_repeats_documents_as_taken(spark):
    rows = [(i, "w " * (i % 17 + 1), "ab"[i % 5 == 0]) for i in range(400)] + [(7, "x", "b"), (7, "x", "b"), (500, "", "none")]
    docs = frame(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    want = sum(r.taken for r in mixing.op4_mixing(docs).collect())
    assert sum(len(r.text.split()) for r in out.collect()) == want and out.where("doc_id = 500").count() == 1
    order = [r.finish for r in mixing.schedule(mixing.queue(docs.selectExpr("doc_id", "source", "size(split(trim(text), ' ')) AS size")), 2000).collect()]
    assert order == sorted(order)


@pytest.mark.parametrize("items", [5, 1 << 16])
def test_the_cut_of_random_tables(spark, items, monkeypatch):
    """Range-sorted in many tasks or one, the budget ends where one sorted list says."""
    monkeypatch.setattr(mixing, "ITEMS", items)
    rng = np.random.default_rng(items)
    rows = [(int(i), str(rng.integers(3)), int(rng.integers(0, 9))) for i in range(120)]
    queued = mixing.settle(mixing.queue(spark.createDataFrame(rows, "doc_id long, source string, size long")))
    ordered = mixing.sorted_items(queued)
    at = sorted((r["at"], r["size"]) for r in ordered.collect())
    for budget in (0, 1, 7, 100, sum(n for _, n in at) // 3, sum(n for _, n in at), 10**6):
        upto, want = 0, 0.0
        for finish in sorted({a for a, _ in at}):
            upto += sum(n for a, n in at if a == finish)
            want = finish if upto <= budget else want
        assert mixing.last_finish(ordered, budget) == want
    order = mixing.schedule(queued, 100).collect()
    assert [r.finish for r in order] == sorted(r.finish for r in order) and sum(r["size"] for r in order) <= 100
    assert sorted((r.doc_id, r.copy) for r in order if r["size"]) == sorted((r.doc_id, k) for r in mixing.take(queued, 100).collect() for k in range(r.copies) if r["size"])


@pytest.mark.parametrize("f", [mixing.op4_mixing, mixing.mix])
def test_mixing_of_an_empty_table(spark, f):
    assert f(frame(spark, [])).collect() == []
