"""Token-ID output: Arrow stream files of fixed-size-list batches.

``write`` encodes every whole text, ends each document with ``end_id`` and packs the
ids, in ascending order of doc_id, into sequences of equal length. Each range of doc_ids
becomes one data file (``ids`` and ``mask``, fixed-size lists, so a sequence lies at a
fixed place of its buffer and maps without copying) and one index file (doc_id, offset,
n_tokens). The last sequence of a file is padded with 0 under a false mask. Ids are 16 bits
wide where the vocabulary fits, else 32.

Null texts count as empty and give the end id alone. Rows of one doc_id (null ids first)
follow each other by text, so reruns agree; extra columns are ignored; an empty table
gives no sequences. A text of any length passes through in pieces of its own batch.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookweave.llm import textkit
from bookweave.session import shared_dir

#: Codes for all bytes, white space included.
BYTE_CODE = np.random.Generator(np.random.PCG64(20240502)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: First bytes of rarer white space and the bytes that may follow: U+0085 and U+00A0, U+1680, U+180E, U+2000 to U+206F, U+3000, U+FEFF.
RARE = {0xC2: {(0x85,), (0xA0,)}, 0xE1: {(0x9A, 0x80), (0xA0, 0x8E)}, 0xE2: {(0x80, x) for x in (*range(0x80, 0x90), 0xA8, 0xA9, 0xAF)} | {(0x81, x) for x in range(0x9F, 0xB0)}, 0xE3: {(0x80, 0x80)}, 0xEF: {(0xBB, 0xBF)}}
SPECIAL = (0x3C, 0x7C)  # how the special token begins
MANIFEST = "part int, docs long, tokens long, data string, index string"


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces that byte-level BPE never joins, and each document's first piece.

    A piece is a word with the one blank before it, or white space between words: its last
    character alone unless that is the word's blank, and the rest. An empty piece closes
    each document. Holds where all white space is ASCII.
    """
    starts, ends, first = textkit.spans(textkit.SPACE[data], offsets)
    n, docs = len(starts), len(offsets) - 1
    at = first[1:]  # each document's end follows its words
    begin, stop = np.insert(starts, at, offsets[1:]), np.insert(ends, at, offsets[1:])
    closes = np.insert(np.zeros(n, bool), at, True)
    before = np.empty(n + docs, np.int64)  # where the last word, or the document, ended
    before[1:] = np.where(closes[:-1], begin[:-1], stop[:-1])
    before[0] = offsets[0]
    gap = begin > before
    blank = np.zeros(n + docs, bool)
    blank[gap] = data[begin[gap] - 1] == 0x20
    rest = np.where(closes | ~gap, begin, begin - 1)  # where the gap's last character starts
    cut = np.where(blank & ~closes, rest, begin)  # where the word's piece starts
    start = np.column_stack([before, rest, cut]).ravel()
    end = np.column_stack([rest, cut, stop]).ravel()
    keep = (end > start) | np.column_stack([closes & False, closes & False, closes]).ravel()
    count = np.cumsum(np.r_[0, keep])
    return start[keep], end[keep], count[3 * np.r_[0, at + np.arange(1, docs + 1)]]


def whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents have special tokens or rarer white space and so must be encoded in one piece."""
    odd = np.flatnonzero((data >= 0x1C) & (data <= 0x1F)).tolist()
    pair = np.flatnonzero(data == SPECIAL[0])
    odd += pair[pair + 1 < len(data)][data[pair[pair + 1 < len(data)] + 1] == SPECIAL[1]].tolist()
    for lead, tails in RARE.items():
        for i in np.flatnonzero(data == lead).tolist() if lead != 0xE2 or len(data) else ():
            if tuple(data[i + 1 : i + 3].tolist()) in tails or tuple(data[i + 1 : i + 2].tolist()) in tails:
                odd.append(i)
    flags = np.zeros(len(offsets) - 1, bool)
    flags[np.searchsorted(offsets, np.array(odd, np.int64), "right") - 1] = True
    return flags


def piecewise(tokenizer) -> bool:
    """Whether pieces can be encoded apart: byte-level BPE over the usual words, nothing done to texts before, and special tokens that begin as ``whole`` knows."""
    state = json.loads(tokenizer.to_str())
    split = state.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    special = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in state.get("added_tokens", []))
    return plain and special and state["model"]["type"] == "BPE" and not state["model"].get("dropout") and not any(state.get(k) for k in ("normalizer", "truncation", "padding"))


class PieceEncoder:
    """Ids of whole texts by a tokenizers file, each with end_id after it.

    The pre-tokenizer never joins text across pieces, so each distinct piece is encoded once and
    its ids remembered under its 64-bit hash, at most ``limit`` of them. Tokenizers of which that is not so encode every text whole.
    """

    def __init__(self, path: str, end_id: int = 0, limit: int = 2_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.limit = Tokenizer.from_file(path), end_id, limit
        self.piecewise = piecewise(self.tokenizer)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """keys: in order."""
        ids = self._encode(texts)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(itertools.chain.from_iterable(ids), self.dtype, int(size.sum()))
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(new)), self.dtype)])
        self.flat[self.used : self.used + len(new)] = new
        where = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size, self.keys = np.insert(self.size, where, size), np.insert(self.keys, where, keys)
        self.used += len(new)

    def run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents in order, number of ids of each)."""
        if not self.piecewise:
            texts = self._encode([data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)])
            counts = np.array([len(t) + 1 for t in texts], np.int64)
            return np.fromiter(itertools.chain.from_iterable((*t, self.end_id) for t in texts), self.dtype, int(counts.sum())), counts
        start, end, first = pieces(data, offsets)
        keys = textkit.hashes(data, start, end, BYTE_CODE)
        odd = np.flatnonzero(whole(data, offsets))
        for d in odd:  # their pieces count as empty ones
            keys[first[d] : first[d + 1]] = 0
        closing = first[1:] - 1
        keys[closing] = 0
        if len(self.keys) > self.limit:
            self.forget()
        some, example, place = np.unique(keys, return_index=True, return_inverse=True)
        known = np.searchsorted(self.keys, some)
        new = np.flatnonzero((some != (self.keys[np.minimum(known, len(self.keys) - 1)] if len(self.keys) else ~some)) & (some != 0))
        if len(new):
            raw = data.tobytes()
            self._learn(some[new], [raw[a:b].decode() for a, b in zip(start[example[new]].tolist(), end[example[new]].tolist(), strict=True)])
        known = np.minimum(np.searchsorted(self.keys, some), max(len(self.keys) - 1, 0))
        at, size = (self.at[known], self.size[known]) if len(self.keys) else (np.zeros(len(some), np.int64), np.zeros(len(some), np.int64))
        size = np.where(some == 0, 0, size)
        sizes, ats = size[place], at[place]
        sizes[closing] = 1
        count = np.r_[0, np.cumsum(sizes)]
        ids = self.flat[np.where(np.repeat(np.isin(np.arange(len(sizes)), closing), sizes), 0, np.repeat(ats - count[:-1], sizes) + np.arange(count[-1]))]
        ids[count[first[1:]] - 1] = self.end_id
        counts = np.diff(count[first])
        if len(odd):
            parts = np.split(ids, count[first[1:-1]])
            for d, text in zip(odd, self._encode([data[offsets[d] : offsets[d + 1]].tobytes().decode() for d in odd]), strict=True):
                parts[d] = np.array([*text, self.end_id], self.dtype)
                counts[d] = len(parts[d])
            ids = np.concatenate(parts)
        return ids, counts


_encoders: dict[tuple[str, int], PieceEncoder] = {}


def encoder_of(path: str, end_id: int) -> PieceEncoder:
    """One for each worker process, whose memory of pieces serves its later tasks too."""
    if (path, end_id) not in _encoders:
        _encoders.clear()
        _encoders[path, end_id] = PieceEncoder(path, end_id)
    return _encoders[path, end_id]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Publish:
    """A stream writer that shows its file only once it is complete; a retried task replaces equal content."""

    def __init__(self, path: str, schema: pa.Schema, attempt: int):
        self.fs, self.path = _open(path)
        self.tmp = f"{self.path}.{attempt}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.file = self.fs.open_output_stream(self.tmp)
        self.writer = pa.ipc.new_stream(self.file, schema)

    def close(self) -> None:
        self.writer.close()
        self.file.close()
        self.fs.move(self.tmp, self.path)


def _schemas(length: int, dtype: np.dtype) -> tuple[pa.Schema, pa.Schema]:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))]), pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])


def _sequences(ids: np.ndarray, used: int, length: int, schema: pa.Schema) -> pa.RecordBatch:
    """ids: whole sequences; used: ids before the padding."""
    mask = pa.array(np.arange(len(ids)) < used)
    return pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), length), pa.FixedSizeListArray.from_arrays(mask, length)], schema=schema)


def write(docs: DataFrame, out: str, tokenizer: str, length: int = 2048, rows: int = 64, end_id: int = 0, run: int = 1 << 21) -> DataFrame:
    """Writes docs (doc_id, text) below out; returns and keeps the manifest, one row for each file with the ids before it (start)."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        encoder = encoder_of(tokenizer, end_id)
        seq, index = _schemas(length, encoder.dtype)
        full = length * rows
        data = docs_file = None
        held, total, n_docs = np.zeros(0, encoder.dtype), 0, 0
        for batch in batches:
            if batch.num_rows and data is None:
                data = _Publish(f"{out}/ids-{part:06d}.arrows", seq, attempt)
                docs_file = _Publish(f"{out}/docs-{part:06d}.arrows", index, attempt)
            for first, end, raw, offsets in textkit.runs(batch.column(1), run):
                ids, counts = encoder.run(raw, offsets)
                docs_file.writer.write_batch(pa.record_batch([batch.column(0).slice(first, end - first).cast(pa.int64()), pa.array(total + np.cumsum(counts) - counts), pa.array(counts)], schema=index))
                held, total, n_docs = np.concatenate([held, ids]), total + len(ids), n_docs + end - first
                whole_rows = len(held) // full * full
                for at in range(0, whole_rows, full):
                    data.writer.write_batch(_sequences(held[at : at + full], full, length, seq))
                held = held[whole_rows:]
        if data is not None:
            if len(held):
                padded = np.concatenate([held, np.zeros(-len(held) % length, encoder.dtype)])
                data.writer.write_batch(_sequences(padded, len(held), length, seq))
            data.close()
            docs_file.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "docs": n_docs, "tokens": total, "data": f"{out}/ids-{part:06d}.arrows", "index": f"{out}/docs-{part:06d}.arrows"}], pa.schema([("part", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("data", pa.string()), ("index", pa.string())]))

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(files, MANIFEST).write.parquet(f"{out}/manifest")
    manifest = docs.sparkSession.read.schema(MANIFEST).parquet(f"{out}/manifest")
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row for each file
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """One row for each document, from the files alone: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian 32-bit integers)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = _open(row["data"])
                index_fs, index_path = _open(row["index"])
                with fs.open_input_stream(path) as f, index_fs.open_input_stream(index_path) as g:
                    sequences = pa.ipc.open_stream(f)
                    held, at = np.zeros(0, "<u4"), 0  # ids from offset at on
                    for docs in pa.ipc.open_stream(g):
                        sums = []
                        for n in docs.column("n_tokens").to_numpy():
                            crc = 0
                            while n:
                                if at == len(held):
                                    block = sequences.read_next_batch()
                                    ids, mask = block.column("ids").flatten(), block.column("mask").flatten()
                                    held, at = ids.to_numpy().astype("<u4")[: mask.true_count], 0
                                take = min(n, len(held) - at)
                                crc = zlib.crc32(held[at : at + take], crc)
                                at, n = at + take, n - take
                            sums.append(crc)
                        start = pa.array(docs.column("offset").to_numpy() + row["start"])
                        yield pa.record_batch([docs.column("doc_id"), start, docs.column("n_tokens"), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return manifest.select("data", "index", "start").repartition(files).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def sequence(path: str, row: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and mask of one sequence of a local data file, mapped from disk; the ids are not copied."""
    with pa.memory_map(path.removeprefix("file://")) as f:
        for batch in pa.ipc.open_stream(f):
            if row < batch.num_rows:
                n = batch.schema.field("ids").type.list_size
                mask = batch.column("mask").slice(row, 1).flatten().to_numpy(zero_copy_only=False)
                return batch.column("ids").slice(row, 1).flatten().to_numpy(zero_copy_only=True)[:n], mask
            row -= batch.num_rows
    raise IndexError(row)


def op10_token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    return read(write(docs, shared_dir(spark, "tokens"), tokenizer))
