"""The pipeline against a brute-force run in plain Python, and columns whose names clash."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bookweave.llm import decontamination, jaccard, mixing, quality, sharding, surrogates

SF = "/root/testdata/sf0.001"


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def words(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def plain_quality(docs, labels):
    """Two Gaussian densities by their formula, on all rows at once."""
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    stats = quality.statistics(pa.array([r["text"] for r in docs]))
    label = {r["doc_id"]: r["quality"] for r in labels}
    at = [i for i, r in enumerate(docs) if r["doc_id"] in label and not held(r["doc_id"])]
    x, y = stats[at], np.array([label[docs[i]["doc_id"]] for i in at])
    n = np.bincount(y, minlength=2)
    covs = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    s = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    log = []
    for k in (0, 1):
        c = 0.9 * covs[k] / np.outer(s, s) + 0.1 * pooled / np.outer(s, s)
        c = 0.9 * c + 0.1 * np.diag(np.diag(c)) + 0.01 * np.eye(len(s))
        d = stats / s - x[y == k].mean(0) / s
        log.append(np.log(n[k] / n.sum()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (d * np.linalg.solve(c, d.T).T).sum(1))
    raw = np.arcsinh((log[1] - log[0]) / 4)
    a, b, z = 1.0, 0.0, raw[at]
    for _ in range(20_000):  # plain descent to the same ridge optimum
        p = 1 / (1 + np.exp(-(a * z + b)))
        a, b = a - 0.002 * (((p - y) * z).sum() + a - 1), b - 0.002 * ((p - y).sum() + b)
    return 1 / (1 + np.exp(-(a * raw + b)))


def plain_near(docs):
    sets = []
    for r in docs:
        w = words(fold(r["text"]))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    least = defaultdict(list)
    for i, r in enumerate(root):
        least[r].append(docs[i]["doc_id"])
    keep = {min(v) for v in least.values()}
    return [r for r in docs if r["doc_id"] in keep]


def plain_clean(docs, bench):
    def toks(t):
        return "".join(c if c.isalnum() or not c.isascii() else " " for c in fold(t)).split()

    out = []
    for r in docs:
        doc, bad = toks(r["text"]), False
        grams = defaultdict(list)
        for i in range(len(doc) - 3):
            grams[tuple(doc[i : i + 4])].append(i)
        for b in bench:
            item, used, covered = toks(b["text"]), set(), set()
            while True:  # the longest match of unused words
                best = (0, 0, 0)
                for j in range(len(item) - 3):
                    for i in grams.get(tuple(item[j : j + 4]), ()):
                        k = 0
                        while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in used and j + k not in covered:
                            k += 1
                        best = max(best, (k, -j, -i))
                if best[0] < 4:
                    break
                used |= set(range(-best[2], -best[2] + best[0]))
                covered |= set(range(-best[1], -best[1] + best[0]))
            bad |= bool(item) and len(covered) / len(item) >= 0.5
        if not bad:
            out.append(r)
    return out


def plain_mix(docs):
    size = [len(words(r["text"])) for r in docs]
    total = defaultdict(int)
    for r, n in zip(docs, size, strict=True):
        total[r["source"]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(size)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * total[s] < weight[s] * level}
        for s in full or open_:
            target[s] = 3 * total[s] if full else weight[s] * level
        if not full:
            break
        left -= sum(3 * total[s] for s in full)
        open_ -= full
    key = lambda i: (int(hashlib.md5(f"mix-1:{docs[i]['doc_id']}".encode()).hexdigest()[:15], 16), docs[i]["doc_id"])
    items, upto = [], Counter()
    for i in sorted(range(len(docs)), key=key):
        s = docs[i]["source"]
        upto[s] += size[i]
        items += [((e * total[s] + upto[s]) / target[s], i) for e in range(3)] if size[i] else []
    spent, copies = 0, Counter()
    for _, i in sorted(items):
        spent += size[i]
        if spent > sum(size):
            break
        copies[docs[i]["doc_id"]] += 1
    return copies


def test_pipeline_against_brute_force(spark):
    read = lambda t: [r.asDict() for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    docs, labels, bench = read("documents"), read("labels"), read("benchmark")
    score = plain_quality(docs, labels)
    assert np.abs(score - 0.7).min() > 1e-3  # no row is too near the threshold to tell
    left = plain_clean(plain_near([r for r, s in zip(docs, score, strict=True) if s >= 0.7]), bench)
    want = plain_mix(left)
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == [*spark.read.parquet(f"{SF}/documents.parquet").columns, "shard"]
    assert Counter(r.doc_id for r in rows) == want
    weight, homes = Counter(), {}
    for r in rows:
        weight[r.shard] += len(r.text.encode()) + 1
        assert homes.setdefault(r.text, r.shard) == r.shard
    heaviest = max(n * (len(t.encode()) + 1) for t, n in Counter(r.text for r in rows).items())
    assert set(weight) <= set(range(8)) and max(weight.values()) - min(weight.values()) <= 2 * heaviest


NAMES = ["_row", "_stats", "score", "predicted", "_hits", "id", "c", "n", "job", "root", "_copies", "_copy", "_source", "_full", "_top", "_place", "_own", "_key", "_new", "_met", "_raw", "entity", "type", "a.b"]


@pytest.mark.parametrize("f", [
    lambda s, d: quality.keep_good(d, s.createDataFrame([(i, int(i > 3), 0) for i in range(40)], "doc_id long, quality int, toxic int")),
    lambda s, d: jaccard.drop_near_duplicates(d), lambda s, d: decontamination.drop_contaminated(d, s.createDataFrame([(1, "some quite other text")], "item_id long, text string")),
    lambda s, d: mixing.mix(d), lambda s, d: sharding.shard_documents(d).drop("shard"), lambda s, d: surrogates.replace_entities(d).drop("n_entities"),
])
def test_columns_of_any_name_pass_through(spark, f):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("words of text "), F.floor(F.col("id") / 2).cast("string"), F.lit(" a@b.org"), F.repeat(F.lit(" !!"), (F.col("id") < 4).cast("int") * 30)).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    docs = docs.select("*", *(F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in NAMES))
    out = f(spark, docs)
    rows = out.collect()
    assert out.columns == docs.columns and rows
    for r in rows:
        assert all(r[n] == f"{n} of {r.doc_id}" for n in NAMES)
