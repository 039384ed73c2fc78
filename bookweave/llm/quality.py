"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every whole text gives a vector of transformed counts and shares. Each class has a mean and a
covariance shrunk towards the pooled one and towards its own diagonal; their Cholesky factors are
computed once. The raw score is the difference of the two log densities, from squared Mahalanobis
distances; a one-variable logistic fit on the training rows turns it into a probability.

Null and empty texts have zero counts and are scored like any other. Labels may repeat a doc_id
(each label row then counts) or be null (ignored). Without labelled rows of both classes every
score is the share of label 1, or 0.5 without labels. Extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.llm import textkit
from bookweave.llm.common import boxed, held_out, settle, travels, unboxed

THRESHOLD = 0.7
KINDS = 13
#: The kind of each byte: control, blank, line end, a-z, A-Z, digit, full stop and comma, ! and ?, quotes and brackets, bar, other sign, first and later bytes of longer characters.
KIND = np.zeros(256, np.int64)
for _kind, _bytes in enumerate((b" \t", b"\n\r\v\f", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:", b"!?", b"'\"()-", b"|", b"#$%&*@^~<>=+_\\/`{}[]", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0))), 1):
    KIND[list(_bytes)] = _kind
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


def _distinct(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each document, how many distinct keys it has and how often its commonest one occurs."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])])
    most = np.zeros(n)
    np.maximum.at(most, doc[new], np.diff(np.r_[new, len(keys)]))
    return np.bincount(doc[new], minlength=n).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text."""
    out = []
    for first, end, data, offsets in textkit.runs(column):
        n, size = end - first, np.diff(offsets)
        kinds = np.bincount(np.repeat(np.arange(n) * KINDS, size) + KIND[data], minlength=n * KINDS).reshape(n, KINDS).astype(float)
        starts, ends, at = textkit.spans(textkit.SPACE[data], offsets)
        word = textkit.hashes(textkit.FOLD[data], starts, ends)
        doc = np.repeat(np.arange(n), np.diff(at))
        count, long = np.diff(at).astype(float), (ends - starts).astype(float)
        last = KIND[data[ends - 1]] if len(ends) else np.zeros(0, int)
        signed = np.bincount(doc[np.isin(last, (7, 9, 10))], minlength=n)
        short = np.bincount(doc[long <= 3], minlength=n)
        spread = np.bincount(doc, np.square(long), minlength=n)
        vary, most = _distinct(word, at)
        pairs, pair_at = textkit.shingles(word, at, 2)
        pair_vary, _ = _distinct(pairs, pair_at)
        line_start, line_end, line_at = textkit.spans(NEWLINE[data], offsets)
        line_vary, _ = _distinct(textkit.hashes(data, line_start, line_end), line_at)
        some, words, letters = np.maximum(size, 1), np.maximum(count, 1), np.maximum(kinds[:, 3] + kinds[:, 4], 1)
        mean = np.bincount(doc, long, minlength=n) / words
        share = lambda x, of: np.sqrt(x / of)
        out.append(np.column_stack([
            np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(np.sqrt(np.maximum(spread / words - mean**2, 0))),
            share(kinds[:, 4], letters), share(kinds[:, 5], some), share(kinds[:, 6], words + kinds[:, 6]), share(kinds[:, 7], words + kinds[:, 7]),
            share(kinds[:, 8], some), share(kinds[:, 9], words + kinds[:, 9]), share(kinds[:, 10], some), share(kinds[:, 11], some), share(kinds[:, 0], some),
            share(signed, words), share(short, words), share(vary, words), share(most, words), share(pair_vary, words), share(line_vary, np.maximum(np.diff(line_at), 1)), share(np.diff(line_at), words),
        ]))
    return np.concatenate(out) if out else np.zeros((0, WIDTH))


WIDTH = 20


def with_statistics(docs: DataFrame) -> DataFrame:
    """Adds _stats, the statistics of each whole text."""

    @F.arrow_udf("array<double>")
    def measured(text: pa.Array) -> pa.Array:
        rows = statistics(text)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * WIDTH, pa.int32()), pa.array(rows.ravel()))

    return docs.withColumn("_stats", measured(F.col("text").cast("string")))


@dataclass
class Model:
    means: np.ndarray  # class, statistic
    factors: np.ndarray  # inverse Cholesky factors of the shrunk covariances
    offset: np.ndarray  # log prior minus half the log determinant, by class
    scale: np.ndarray  # of the statistics
    link: tuple[float, float]  # slope and intercept of the logistic link
    rate: float | None = None  # the only score, where there is no second class

    def raw(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        density = [o - 0.5 * np.square((x - m) @ f.T).sum(1) for m, f, o in zip(self.means, self.factors, self.offset, strict=True)]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.rate is not None:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-np.clip(self.link[0] * squash(self.raw(x)) + self.link[1], -40, 40)))


def squash(raw: np.ndarray) -> np.ndarray:
    """Log densities of odd texts differ by thousands; this keeps their order."""
    return np.arcsinh(raw / 4)


def fit(stats: DataFrame, labels: DataFrame, shrink: float = 0.1, diagonal: float = 0.1) -> Model:
    """stats: doc_id, _stats. Learns from all labelled rows that are not held out; sums and histograms alone reach the driver."""
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
    rows = settle(stats.where(~held_out(F.col("doc_id"))).join(known, F.col("doc_id") == F.col("_id")).select("_label", "_stats"))
    outer = F.flatten(F.transform("_stats", lambda a: F.transform("_stats", lambda b: a * b)))
    terms = rows.select("_label", F.posexplode(F.concat(F.array(F.lit(1.0)), "_stats", outer)))
    sums = {0: np.zeros(1 + WIDTH + WIDTH**2), 1: np.zeros(1 + WIDTH + WIDTH**2)}
    for label, at, total in terms.groupBy("_label", "pos").agg(F.sum("col")).collect():  # 2 * 421 rows
        sums[label][at] = total
    n = np.array([sums[0][0], sums[1][0]])
    if not n.all():
        return Model(*[np.zeros(0)] * 4, (1.0, 0.0), rate=float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = np.array([sums[k][1 : 1 + WIDTH] / n[k] for k in (0, 1)])
    moment = np.array([sums[k][1 + WIDTH :].reshape(WIDTH, WIDTH) / n[k] for k in (0, 1)])
    cov = moment - mean[:, :, None] * mean[:, None, :]
    pooled = (cov * n[:, None, None]).sum(0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    cov, pooled, mean = cov / np.outer(scale, scale), pooled / np.outer(scale, scale), mean / scale
    cov = (1 - shrink) * cov + shrink * pooled
    cov = (1 - diagonal) * cov + diagonal * np.array([np.diag(np.diag(c)) for c in cov]) + 1e-2 * np.eye(WIDTH)
    factor = np.linalg.cholesky(cov)
    inverse = np.array([np.linalg.inv(f) for f in factor])
    offset = np.log(n / n.sum()) - np.log(np.diagonal(factor, axis1=1, axis2=2)).sum(1)
    model = Model(mean, inverse, offset, scale, (1.0, 0.0))

    @F.arrow_udf("int")
    def binned(x: pa.Array) -> pa.Array:
        return pa.array(np.rint(50 * np.clip(squash(model.raw(_matrix(x))), -12, 12)).astype(np.int32))

    table = rows.select("_label", binned("_stats").alias("_bin")).groupBy("_label", "_bin").count().collect()  # at most 2 * 1,201 rows
    y, x, w = (np.array([r[i] for r in table], float) for i in (0, 1, 2))
    model.link = _logistic(x / 50, y, w)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and intercept by Newton's method; the ridge keeps them finite where the classes part."""
    a, design = np.array([1.0, 0.0]), np.column_stack([x, np.ones_like(x)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -40, 40)))
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        a = a - np.clip(np.linalg.solve(hessian, design.T @ (w * (p - y)) + ridge * (a - [1.0, 0.0])), -1, 1)
    return float(a[0]), float(a[1])


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def score(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from the threshold on); drops _stats."""

    @F.arrow_udf("double")
    def scored(x: pa.Array) -> pa.Array:
        return pa.array(np.round(model.score(_matrix(x)), 9))

    return stats.withColumn("score", scored("_stats")).drop("_stats").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = settle(with_statistics(docs.select("doc_id", "text")).drop("text"))
    return score(stats, fit(stats, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their columns.

    Labelled texts are measured for the fit, then all for their scores: keeping the measures beside the texts would
    write every text once more. Where the labels are too many to travel, unlabelled texts are measured twice too.
    """
    ids = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("_id")).distinct()
    some = docs.select("doc_id", "text")
    if travels(ids):
        some = some.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    model = fit(with_statistics(some), labels)
    return unboxed(score(with_statistics(boxed(docs, "text")), model).where("predicted = 1"))
