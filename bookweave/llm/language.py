"""Language identification by error-correcting output codes.

Each language has a codeword of -1 and 1; each bit has a logistic classifier over hashed byte
2-grams and 3-grams. A text goes to the language whose codeword has the least logistic loss, bits
weighted by how well they did in training. The text is ambiguous where the two best are close.

Null texts and texts without a letter are ``und`` with score 0. One learned language needs no bits
and always wins with score 1; without any, every text is ``und``. Texts are taken whole; a language
is a label as it stands, so equal names in other case differ. Extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.llm import textkit
from bookweave.llm.common import held_out

WIDTH = 1 << 12
#: Letters in lower case and bytes of longer characters count; all other bytes are one blank.
LETTER = np.full(256, 32, np.uint32)
LETTER[97:123] = LETTER[65:91] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


def grams(column: pa.Array, docs: int = 256):
    """(first, end, shares) of runs of texts: shares of each hashed 2-gram and 3-gram, of all in the text."""
    for first, end, data, offsets in textkit.runs(column):
        letters = LETTER[data]
        for a in range(0, end - first, docs):
            b = min(a + docs, end - first)
            part, at = letters[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            doc = np.repeat(np.arange(b - a, dtype=np.int64) * WIDTH, np.diff(at))
            counts = np.zeros((b - a) * WIDTH)
            for n in (2, 3):
                if len(part) < n:
                    continue
                key = sum(part[i : len(part) - n + 1 + i] << np.uint32(8 * (n - 1 - i)) for i in range(n))
                keep = (doc[n - 1 :] == doc[: len(doc) - n + 1]) & (part[: len(part) - n + 1] != part[1 : len(part) - n + 2])
                slot = ((key * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
                counts += np.bincount((slot + doc[: len(slot)])[keep], minlength=len(counts))
            counts = counts.reshape(b - a, WIDTH)
            yield first + a, first + b, counts / np.maximum(counts.sum(1, keepdims=True), 1)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k rows of -1 and 1: all the ways to part up to 5 classes in two, else the most distant of some random codes."""
    if k <= 5:
        bits = [c for c in product((-1, 1), repeat=k) if c[0] == 1 and -1 in c]
        return np.array(bits).T.reshape(k, len(bits))
    rng, best, wide = np.random.Generator(np.random.PCG64(seed)), None, int(np.ceil(10 * np.log2(k)))
    for _ in range(200):
        code = rng.choice((-1, 1), (k, wide))
        code[0, np.abs(code.sum(0)) == k] *= -1  # a bit must part the classes
        gap = (wide - (code @ code.T)[~np.eye(k, dtype=bool)]).min()
        if best is None or gap > best[0]:
            best = gap, code
    return best[1]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # language, bit
    weights: np.ndarray  # gram, bit
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def losses(self, shares: np.ndarray) -> np.ndarray:
        margin = shares @ self.weights + self.bias
        return (np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.trust).sum(2)

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score, ambiguous) of each text."""
        best, score, close = np.zeros(len(column), int), np.ones(len(column)), np.zeros(len(column), bool)
        if len(self.langs) > 1:
            for a, b, shares in grams(column):
                loss = self.losses(shares)
                low = np.sort(loss, 1)
                best[a:b] = loss.argmin(1)
                score[a:b] = 1 / np.exp(np.clip(loss.min(1, keepdims=True) - loss, -50, 0)).sum(1)
                close[a:b] = low[:, 1] - low[:, 0] < 0.1 * self.trust.sum()
        return best, score, close


def fit(docs: DataFrame, sample: int = 4000, rounds: int = 150, decay: float = 1e-4) -> Model:
    """Learns from about ``sample`` texts, the same share of ids of each language, from rows that are neither held out nor without a language; that many sparse vectors reach the driver."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(counts)
    if len(langs) < 2:
        return Model(langs, np.zeros((len(langs), 0)), np.zeros((WIDTH, 0)), np.zeros(0), np.zeros(0))
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(sample / len(langs) / counts[lang])).otherwise(share)
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))

    @F.arrow_udf("struct<at:array<int>,x:array<float>>")
    def sparse(text: pa.Array) -> pa.Array:
        at, x = [], []
        for _, _, shares in grams(text):
            for row in shares:
                at.append(np.flatnonzero(row).astype(np.int32))
                x.append(row[at[-1]].astype(np.float32))
        return pa.StructArray.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array(x, pa.list_(pa.float32()))], ["at", "x"])

    rows = picked.select("lang", F.xxhash64("doc_id", F.lit(11)).alias("h"), "doc_id", sparse("text").alias("v"))
    rows = rows.orderBy("h", "doc_id").limit(2 * sample).select("lang", "v").toArrow()  # repeated ids can't exceed that
    x = np.zeros((rows.num_rows, WIDTH), np.float32)
    v = rows.column("v").combine_chunks()
    ends = np.cumsum([0, *(len(a) for a in v.field("at"))])
    x[np.repeat(np.arange(rows.num_rows), np.diff(ends)), v.field("at").flatten().to_numpy()] = v.field("x").flatten().to_numpy()
    y = np.array([langs.index(a) for a in rows.column("lang").to_pylist()], int)
    return train(x, y, langs, rounds, decay)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], rounds: int = 150, decay: float = 1e-4) -> Model:
    """One logistic classifier for each bit, all at once, by accelerated gradient steps; x is changed in place."""
    code = codewords(len(langs))
    present = np.bincount(y, minlength=len(langs))
    each = (1 / np.maximum(present, 1))[y].astype(np.float32)
    each *= len(y) / max(each.sum(), 1e-9)
    n = max(len(x), 1)
    centre = x.mean(0)
    scale = (1 / np.maximum(x.std(0), 1e-4)).astype(np.float32)
    x -= centre
    x *= scale
    goal = code[y].astype(np.float32)
    w = np.zeros((x.shape[1] + 1, code.shape[1]), np.float32)  # the last row is the bias
    look, step = w.copy(), 4.0 / max(1 + float(np.einsum("ij,ij->", x, x, dtype=np.float64)) / n, 1.0)
    for i in range(rounds):
        pull = goal * each[:, None] / (1 + np.exp(np.clip((x @ look[:-1] + look[-1]) * goal, -30, 30)))
        slope = -np.vstack([x.T @ pull, pull.sum(0, keepdims=True)]) / n + decay * look
        new = look - step * slope
        look, w = new + i / (i + 3) * (new - w), new
    wrong = (((x @ w[:-1] + w[-1]) * goal <= 0) * each[:, None]).mean(0) if len(x) else np.zeros(code.shape[1])
    weights = w[:-1] * scale[:, None]
    return Model(langs, code, weights.astype(float), (w[-1] - centre @ weights).astype(float), np.maximum(1 - 2 * wrong, 0.05))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, score and ambiguous to docs, in place of columns of these names."""
    langs = np.array([*model.langs, "und"], object)

    @F.arrow_udf("struct<lang:string,score:double,ambiguous:boolean>")
    def identified(text: pa.Array) -> pa.Array:
        best, score, close = model.predict(text)
        return pa.StructArray.from_arrays([pa.array(langs[best].tolist(), pa.string()), pa.array(np.round(score, 9)), pa.array(close)], ["lang", "score", "ambiguous"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(model.langs))
    out = docs.withColumn("_l", identified(F.col("text").cast("string"))).withColumn("_some", lettered)
    return out.select(
        *(docs[c] for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")),
        F.when(F.col("_some"), F.col("_l.lang")).otherwise("und").alias("lang_pred"),
        F.when(F.col("_some"), F.col("_l.score")).otherwise(0.0).alias("score"),
        (F.col("_some") & F.col("_l.ambiguous")).alias("ambiguous"),
    )


def op7_language(docs: DataFrame) -> DataFrame:
    model = fit(docs)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
