"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Around each word that speaks of licences, words run on as in a short notice: all of them words of the notices, or
with a few others between. These runs, cut at the line's and at the paragraph's ends, are segments, met by
short notices and SPDX tags; a tag's identifier must be the template's own, word by word. Wherever words run as in a header block or licence text, across
line ends and whatever the marks between, the whole stretch is a body, met by headers and full texts. A
segment or body and a template become sparse vectors of words and word pairs, weighed by how rare they are in
all documents; the template of greatest cosine names the licence if it reaches the threshold. Files that have
no licence of their own take that of the nearest directory, their own first and then its ancestors, that
holds a licence file with a known licence: a file by such a name, or one that is a licence text for the most part.
Only real paths count: tables without a column ``path`` inherit nothing.

Null and empty texts have no segments. Ties go to the first template; of a directory's licence files the
best scored one counts, then the least path. A null path inherits nothing and passes nothing on. Equal rows get equal results;
extra columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookweave.llm import textkit
from bookweave.llm.common import carried, settle
from bookweave.llm.decontamination import BREAK, tokens
from bookweave.llm.license_texts import TEXTS

THRESHOLD = 0.5
#: Other words that may stand between two words of a notice.
BETWEEN = 3
#: Words of a run that marks a body, words between two runs of one body, and covered words of the least body.
SEED, GAP, LEAST = 5, 24, 8
#: Share of a document's words in bodies from which it is a licence file.
COVERED = 0.5
# Usual notices of common licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, licensed under the MIT License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 license."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "Released into the public domain under the Unlicense license."),
]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(n for n, _ in TEMPLATES)]
TAG = re.compile(r"SPDX-License-Identifier:\s*\(?\s*([A-Za-z0-9.+-]+)", re.IGNORECASE)
ANCHORS = "spdx license licence licensed licenced licenses licences licensing copyright unlicense".split()
FILES = r"(?i)(?:^|/)(?:licen[sc]e|copying|unlicense|notice)[^/]*$"
LINE = re.compile(rb"\n")
BLANK = re.compile(rb"\n[^0-9A-Za-z\x80-\xff\n]*(?=\n)")
TOKEN = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def terms(text: str) -> Counter:
    w = TOKEN.findall("".join(c.lower() if c.isascii() else c for c in text))
    return Counter(w) + Counter(map(" ".join, zip(w, w[1:], strict=False)))


def _hash_words(names: list[str]) -> np.ndarray:
    out = [tokens(data, offsets)[0] for _, _, data, offsets in textkit.runs(pa.array(names))]
    return np.concatenate(out)


VOCABULARY = sorted({w for _, t in TEMPLATES + TEXTS for w in terms(t) if " " not in w})


@cache
def _keys() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchors, of the vocabulary (and its order), of the runs of words in header blocks and licence texts, a filter for these, and of the notices' words."""
    vocabulary = _hash_words(VOCABULARY)
    seeds = [textkit.shingles(*tokens(data, offsets), SEED)[0] for _, _, data, offsets in textkit.runs(pa.array([t for _, t in TEXTS]))]
    seeds = np.unique(np.concatenate(seeds))
    maybe = np.zeros(1 << 20, bool)
    maybe[(seeds >> np.uint64(44)).astype(np.int64)] = True
    notices = sorted({w for _, t in TEMPLATES for w in terms(t) if " " not in w})
    return np.sort(_hash_words(ANCHORS)), vocabulary, np.argsort(vocabulary), seeds, maybe, np.sort(_hash_words(notices))


def _bodies(word: np.ndarray, doc: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(first word, last word) of each body, and whether a word is covered by a run of one."""
    _, _, _, seeds, maybe, _ = _keys()
    covered = np.zeros(len(word), bool)
    n = len(word) - SEED + 1
    if n <= 0:
        return [], covered
    rolled = word[:n] * textkit.STEP[0]
    for i in range(1, SEED):
        rolled += word[i : n + i] * textkit.STEP[i]
    rolled = textkit.mix(rolled)
    hit = np.flatnonzero(maybe[(rolled >> np.uint64(44)).astype(np.int64)] & (doc[:n] == doc[SEED - 1 :]))
    hit = hit[np.isin(rolled[hit], seeds)]
    for i in range(SEED):
        covered[hit + i] = True
    new = np.flatnonzero(np.r_[True, (np.diff(hit) > SEED + GAP) | (np.diff(doc[hit]) != 0)]) if len(hit) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(hit[new], hit[np.r_[new[1:] - 1, len(hit) - 1]] + SEED if len(hit) else [], strict=True):
        if covered[a:b].sum() >= LEAST:
            out.append((int(a), int(b) - 1))
        else:
            covered[a:b] = False
    return out, covered


def _stretches(word: np.ndarray, doc: np.ndarray, notices: np.ndarray, anchor: np.ndarray) -> list[tuple[int, int]]:
    """(first word, last word) of the runs of notice words that hold an anchor (a flag of each word): without other words between, and with a few."""
    known = np.flatnonzero(np.isin(word, notices))
    upto = np.r_[0, np.cumsum(anchor)]
    if not upto[-1]:
        return []
    out = set()
    for gap in (0, BETWEEN):
        new = np.flatnonzero(np.r_[True, (np.diff(known) > gap + 1) | (np.diff(doc[known]) != 0)])
        first, last = known[new], known[np.r_[new[1:] - 1, len(known) - 1]]
        some = upto[last + 1] > upto[first]
        out.update(zip(first[some].tolist(), last[some].tolist(), strict=True))
    return sorted(out)


def segments(column: pa.Array) -> tuple[list[list[str]], list[list[str]], list[float], list[list[int]]]:
    """The segments and bodies of each text, the share of its words that bodies cover, and which words of the vocabulary it has."""
    anchors, vocabulary, order, _, _, notices = _keys()
    found: list[list[str]] = []
    long: list[list[str]] = []
    share: list[float] = []
    words: list[list[int]] = []
    for _, _, data, offsets in textkit.runs(column):
        starts, ends, first = textkit.spans(BREAK[data], offsets)
        word = textkit.hashes(textkit.FOLD[data], starts, ends)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        known = np.flatnonzero(np.isin(word, vocabulary))
        pairs = np.unique(doc[known] * len(vocabulary) + order[np.searchsorted(vocabulary, word[known], sorter=order)])
        by = np.searchsorted(pairs, np.arange(len(offsets)) * len(vocabulary))
        words += [(pairs[a:b] % len(vocabulary)).tolist() for a, b in zip(by, by[1:], strict=False)]
        some: list[list[str]] = [[] for _ in range(len(offsets) - 1)]
        whole: list[list[str]] = [[] for _ in range(len(offsets) - 1)]
        places, covered = _bodies(word, doc)
        for a, b in places:
            whole[doc[a]].append(data[starts[a] : ends[b]].tobytes().decode("utf-8", "replace"))
        total = np.r_[0, np.cumsum(covered)]
        share += ((total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)).tolist()
        flag = np.isin(word, anchors)
        for i, j in _stretches(word, doc, notices, flag):
            d, at, raw = int(doc[i]), int(starts[i]), data[starts[i] : ends[j]].tobytes()
            anchor = (starts[i : j + 1][flag[i : j + 1]] - at).tolist()
            for breaks in (LINE, BLANK):
                cuts = [0, *(m.end() for m in breaks.finditer(raw)), len(raw)]
                for x, y in zip(cuts, cuts[1:], strict=False):
                    if any(x <= n < y for n in anchor):
                        part = raw[x:y].decode("utf-8", "replace")
                        if part not in some[d]:
                            some[d].append(part)
        found += some
        long += whole
    return found, long, share, words


class Matcher:
    """Sparse vectors of the templates under given document frequencies of words."""

    def __init__(self, documents: int, frequency: dict[str, int], texts: list[tuple[str, str]]):
        self.idf = lambda t: min(1 + math.log((1 + documents) / (1 + frequency.get(w, 0))) for w in t.split(" ")) if " " not in t else max(1 + math.log((1 + documents) / (1 + frequency.get(w, 0))) for w in t.split(" "))
        self.known = {t for _, text in texts for t in terms(text)}
        self.templates = [(name, self.vector(text)) for name, text in texts]

    def vector(self, text: str) -> dict[str, float]:
        v = {t: n * self.idf(t) for t, n in terms(text).items() if t in self.known}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}

    def best(self, texts: list[str]) -> tuple[str | None, float]:
        out: tuple[str | None, float] = (None, 0.0)
        for text in texts:
            v, tag = self.vector(text), TAG.search(text)
            for name, template in self.templates:
                if ("spdx" in template) != bool(tag) or (tag and re.sub(r"(?i)(-only|-or-later|\+)$", "", tag[1]).rstrip(".").lower() != name.lower()):
                    continue
                cosine = sum(x * template.get(t, 0.0) for t, x in v.items())
                if cosine > out[1] + 1e-12:
                    out = name, cosine
        return out


def measured(docs: DataFrame) -> DataFrame:
    """Adds _m: the segments, bodies, share of words in bodies, and vocabulary words of each whole text."""

    @F.arrow_udf("struct<segments:array<string>,bodies:array<string>,share:double,words:array<int>>")
    def scanned(text: pa.Array) -> pa.Array:
        found, long, share, words = segments(text)
        return pa.StructArray.from_arrays([pa.array(found, pa.list_(pa.string())), pa.array(long, pa.list_(pa.string())), pa.array(share, pa.float64()), pa.array(words, pa.list_(pa.int32()))], ["segments", "bodies", "share", "words"])

    return docs.withColumn("_m", scanned(F.col("text").cast("string")))


def inherit(files: DataFrame, most: int | None = None) -> DataFrame:
    """files: path, license, score, whole (a licence text for the most part) and any others. Adds inherited and inherited_from, the nearest directory's licence."""
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    files = files.withColumn("_dir", folder)
    known = files.where((F.col("path").rlike(FILES) | F.col("whole")) & F.col("license").isNotNull())
    homes = known.groupBy(F.col("_dir").alias("_home")).agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("_l"))
    parts = F.split("_dir", "/")
    above = F.concat(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")), F.array(F.lit("")))
    dirs = files.where("_dir IS NOT NULL").select("_dir").distinct()
    up = dirs.select("_dir", F.explode(F.array_distinct(above)).alias("_home"))
    nearest = up.join(homes, "_home").groupBy(F.col("_dir").alias("_of")).agg(F.max(F.struct(F.length("_home").alias("n"), "_home", F.col("_l.license").alias("license"))).alias("_near"))
    return files.join(carried(settle(nearest), most), F.col("_dir") == F.col("_of"), "left").withColumn("inherited", F.col("_near.license")).withColumn("inherited_from", F.col("_near._home")).drop("_dir", "_of", "_near")


def scan(docs: DataFrame, path: Column, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, license, score, origin (own, inherited or null) and inherited_from."""
    rows = settle(measured(docs.select("doc_id", path.cast("string").alias("_path"), "text")).select("doc_id", F.col("_path").alias("path"), "_m"))
    frequency = {VOCABULARY[r.w]: r.n for r in rows.select(F.explode("_m.words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}  # a row for each word of the templates
    total = rows.count()

    @F.arrow_udf("struct<license:string,score:double>")
    def matched(found: pa.Array, long: pa.Array) -> pa.Array:
        notices, texts = Matcher(total, frequency, TEMPLATES), Matcher(total, frequency, TEXTS) if any(long.to_pylist()) else None
        best = []
        for x, y in zip(found.to_pylist(), long.to_pylist(), strict=True):
            pairs = (notices.best(x) if x else (None, 0.0), texts.best(y) if y else (None, 0.0))
            best.append(max(pairs, key=lambda b: round(b[1], 9)))
        return pa.StructArray.from_arrays([pa.array([b[0] if b[1] >= threshold else None for b in best], pa.string()), pa.array([round(b[1], 9) for b in best], pa.float64())], ["license", "score"])

    own = settle(rows.withColumn("b", matched("_m.segments", "_m.bodies")).select("doc_id", "path", "b.license", "b.score", (F.col("_m.share") >= COVERED).alias("whole")))
    found = inherit(own)
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited")
    from_ = F.when(F.col("license").isNull(), F.col("inherited_from"))
    return found.select("doc_id", "path", F.coalesce("license", "inherited").alias("license"), "score", origin.alias("origin"), from_.alias("inherited_from"))


def op9_licenses(docs: DataFrame) -> DataFrame:
    """The scan of all documents; without a column ``path`` there are no directories, and licences are the documents' own."""
    return scan(docs, F.col("path") if "path" in docs.columns else F.lit(None))
