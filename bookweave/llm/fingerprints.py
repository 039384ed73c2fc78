"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Each word shingle (five words, A-Z folded) is hashed once; its top bits choose one of 512 bins and
each bin keeps its least hash. An empty bin takes the value of the first filled bin in an order of its
own, the same for all documents. Four low-order bits of each value, mixed with the bin's number, are
packed to 256 bytes, written as hexadecimal. Likeness is the share of equal bins, corrected for the
one in sixteen that agree by chance, and never below 0.

Null texts count as empty. A text without words has the empty fingerprint: likeness 1 to another
such text and 0 to any other. Equal word sequences have equal fingerprints. Descending doc_id orders
documents; rows of one doc_id follow by text, null ids come last, equal rows are interchangeable. A
single row is its own next document; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.llm import textkit

BINS, BITS, WORDS = 512, 4, 5
NONE = np.uint64(2**64 - 1)
_rng = np.random.Generator(np.random.PCG64(20240503))
#: For each bin, the order in which it asks the bins for a value.
ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1).astype(np.int16)
RANK = np.argsort(ORDER, axis=1).astype(np.int16)
SALT = _rng.integers(0, 2**63, BINS, dtype=np.uint64)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def densify(table: np.ndarray) -> np.ndarray:
    """Fills the empty bins of rows that have a filled one."""
    filled = table != NONE
    out = table.copy()
    some = filled.any(1)
    row, slot = np.nonzero(~filled & some[:, None])
    for turn in range(12):  # most bins find a donor at once
        donor = ORDER[slot, turn]
        hit = filled[row, donor]
        out[row[hit], slot[hit]] = table[row[hit], donor[hit]]
        row, slot = row[~hit], slot[~hit]
        if not len(row):
            return out
    for r in np.unique(row):
        mine, donors = slot[row == r], np.flatnonzero(filled[r])
        out[r, mine] = table[r, donors[RANK[mine[:, None], donors].argmin(1)]]
    return out


def fingerprints(column: pa.Array, words: int = WORDS) -> np.ndarray:
    """One row of packed bits (uint8) for each text, and whether it has words, as the last column."""
    out = []
    for _, _, data, offsets in textkit.runs(column):
        sh, at = textkit.shingles(*textkit.words(data, offsets), words)
        for a in range(0, len(at) - 1, 512):
            b = min(a + 512, len(at) - 1)
            part, n = sh[at[a] : at[b]], np.diff(at[a : b + 1])
            table = np.full((b - a) * BINS, NONE)
            slot = (part >> np.uint64(55)).astype(np.int64) + np.repeat(np.arange(b - a) * BINS, n)
            np.minimum.at(table, slot, part)
            low = textkit.mix(densify(table.reshape(b - a, BINS)) ^ SALT) & np.uint64(15)
            low[n == 0] = 0
            packed = (low[:, 0::2] << np.uint64(4) | low[:, 1::2]).astype(np.uint8)
            out.append(np.column_stack([packed, (n > 0).astype(np.uint8)]))
    return np.concatenate(out) if out else np.zeros((0, BINS // 2 + 1), np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows of two arrays of fingerprints."""
    differ = a[:, :-1] ^ b[:, :-1]
    equal = ((differ >> 4) == 0).sum(1) + ((differ & 15) == 0).sum(1)
    chance = 1 / (1 << BITS)
    near = np.maximum(0.0, (equal / BINS - chance) / (1 - chance))
    return np.where((a[:, -1] & b[:, -1]) == 1, near, (a[:, -1] == b[:, -1]).astype(float))


def text_of(row: np.ndarray) -> str:
    return row[:-1].tobytes().hex() if row[-1] else ""


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many first characters of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(docs: DataFrame, partitions: int) -> DataFrame:
    """Rows (part, halo, doc_id, text): each partition holds a range of doc_ids in descending order, then the row that follows it.

    The ranges come from a pass over the ids alone; one pair of numbers for each partition reaches the driver.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = docs.select(key.alias("key")).repartitionByRange(partitions, "key")
    bounds = ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()
    bounds = sorted((b.low, b.high) for b in bounds)
    lows, highs = np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64)

    @F.arrow_udf("array<int>")
    def places(keys: pa.Array) -> pa.Array:
        keys = keys.to_numpy(zero_copy_only=False)
        own = np.searchsorted(lows, keys, "right") - 1
        top = keys == highs[own]  # also follows the last row of the range above, or of the lowest range
        above = (own + 1) % len(lows)
        return pa.array([[o, a] if t else [o] for o, a, t in zip(own.tolist(), above.tolist(), top.tolist(), strict=True)], pa.list_(pa.int32()))

    if not bounds:
        return docs.select(F.lit(0).alias("part"), F.lit(False).alias("halo"), "doc_id", "text").limit(0)
    rows = docs.select("doc_id", "text", key.alias("key")).withColumn("places", places("key"))
    rows = rows.select(F.posexplode("places").alias("at", "part"), "key", "doc_id", "text").withColumn("halo", F.col("at") > 0)
    spread = rows.repartitionById(len(bounds), F.col("part"))
    return spread.sortWithinPartitions("part", "halo", F.desc("key"), F.asc_nulls_first("text")).select("part", "halo", "doc_id", "text")


def fingerprint_pairs(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The fingerprint of each text and of its edited form, and both likenesses."""
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for part, halo, doc, text in zip(*columns, strict=True):
                held.append((part, halo, doc, text or ""))
                weight += len(held[-1][3])
                if weight > textkit.RUN_BYTES:
                    yield finish(held)
                    held, weight = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield finish(held)

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, which only follows."""
        own = fingerprints(pa.array([r[3] for r in rows], pa.large_string()))
        keep = [i for i in range(len(rows) - 1) if not rows[i][1]]
        new = [edited(rows[i][3], rows[i + 1][3]) for i in keep]
        changed = fingerprints(pa.array(new, pa.large_string()))
        here, after = own[keep], own[[i + 1 for i in keep]]
        return pa.record_batch([
            pa.array([rows[i][2] for i in keep], pa.int64()), pa.array([len(rows[i][3]) for i in keep], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            pa.array([text_of(r) for r in here], pa.string()), pa.array([text_of(r) for r in changed], pa.string()),
            pa.array(likeness(here, changed)), pa.array(likeness(here, after)),
        ], schema=schema)

    return neighbours(docs, partitions).mapInArrow(pairs, SCHEMA)


op3_fingerprints = fingerprint_pairs
