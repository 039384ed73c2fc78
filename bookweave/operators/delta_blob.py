"""The bytes of the delta format: encode, decode, inspect and verify one day's sampled book.

A blob is one zstd stream over a magic number, a JSON header with its length, a validity bitmap for
each 32-bit column, times and best prices as 32-bit differences after a 64-bit start, deeper prices as
32-bit offsets from the best, and sizes as they are. All numbers are little-endian. Each day is one
Arrow table in one task, as the format is one file for each day.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from bookweave.functions.scalars import DEPTH, SCALE
from bookweave.operators.replay import DAY, SIDES, book_columns

# Fixed values of the format.
MAGIC = b"OKXD\x00\x00\x00\x01"
FORMAT, SIZES, BITMAP = "base_offset_v1", "raw_f32", "one_bitmap_per_f32_column"
MOST_HEADER, LEVELS = 64 * 1024, range(1, 23)
INT32, INT64 = np.iinfo(np.int32), np.iinfo(np.int64)


class BlobError(ValueError):
    """A book that can't be coded, or bytes that are no blob."""


def header(rows: int, scale: int, depth: int = DEPTH) -> dict:
    names = lambda kind, sides: [f"{s}_{kind}_{i}" for s in sides for i in range(depth)]
    return {"format": FORMAT, "rows": rows, "depth": depth, "scale": scale, "timestamp": "timestamp_ms", "bid_px_cols": names("px", ["bid"]), "ask_px_cols": names("px", ["ask"]), "size_cols": names("sz", SIDES), "sizes": SIZES, "null_bitmap": BITMAP}


def _steps(values: np.ndarray, what: str) -> bytes:
    """A 64-bit start and 32-bit differences."""
    step = np.diff(values.astype(object)) if len(values) and np.abs(values.astype(float)).max() > 2**62 else np.diff(values)
    if len(step) and (min(step) < INT32.min or max(step) > INT32.max):
        raise BlobError(f"{what}: a step needs more than 32 bits")
    return values[:1].astype("<i8").tobytes() + step.astype("<i4").tobytes()


def whole_prices(values: np.ndarray, present: np.ndarray, scale: int, what: str) -> np.ndarray:
    """Prices times scale as whole numbers, 0 where absent; an error unless each restores its price bit by bit."""
    if not np.isfinite(values[present]).all():
        raise BlobError(f"{what}: a price is not a finite number")
    exact = np.where(present, values, np.float32(0)).astype(np.float64) * scale
    scaled = np.trunc(exact + np.copysign(0.5, exact))
    scaled = np.where(np.abs(exact) >= 2**52, exact, scaled)
    scaled = np.where(np.abs(scaled - exact) > 0.5, np.rint(exact), scaled)  # where adding a half itself rounded up
    if (np.abs(scaled) >= 2.0**63).any():
        raise BlobError(f"{what}: a price times the scale leaves 64 bits")
    out = scaled.astype(np.int64)
    back = (out.astype(np.float64) / scale).astype(np.float32)
    if (back.view(np.uint32) != np.where(present, values, np.float32(0)).view(np.uint32))[present].any():
        raise BlobError(f"{what}: scale {scale} does not give a price back bit by bit")
    return out


def columns(table: pa.Table, depth: int = DEPTH) -> tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Times, and values and presence of each 32-bit column; checks names, types and times."""
    for name, kind in (("timestamp_ms", pa.int64()), *((c, pa.float32()) for c in book_columns(depth))):
        if name not in table.column_names:
            raise BlobError(f"the book lacks column {name}")
        if table.schema.field(name).type != kind:
            raise BlobError(f"{name} is {table.schema.field(name).type}, not {kind}")
    times = table["timestamp_ms"].combine_chunks()
    if times.null_count:
        raise BlobError("a null among the times")
    cells = {}
    for name in book_columns(depth):
        column = table[name].combine_chunks()
        present = np.asarray(column.is_valid())
        cells[name] = np.where(present, column.fill_null(0.0).to_numpy(zero_copy_only=False), np.float32(0)).astype(np.float32), present
    return times.to_numpy(), cells


def pack(table: pa.Table, scale: int = SCALE, depth: int = DEPTH) -> bytes:
    """A sampled book's uncompressed blob."""
    if scale <= 0:
        raise BlobError(f"scale {scale} is not above 0")
    times, cells = columns(table, depth)
    rows = len(times)
    if not rows:
        raise BlobError("a book without rows has no blob")
    head = json.dumps(header(rows, scale, depth), separators=(",", ":")).encode()
    out = [MAGIC, np.array([len(head)], "<u4").tobytes(), head]
    out += [np.packbits(cells[name][1], bitorder="little").tobytes() for name in book_columns(depth)]
    out.append(_steps(times, "timestamp_ms"))
    for side, sign in zip(SIDES, (-1, 1), strict=True):
        if not cells[f"{side}_px_0"][1].all():
            raise BlobError(f"row {int(np.argmin(cells[f'{side}_px_0'][1]))} has no best {side}")
        whole = [whole_prices(*cells[f"{side}_px_{i}"], scale, f"{side}_px_{i}") for i in range(depth)]
        out.append(_steps(whole[0], f"best {side}"))
        offset = np.column_stack([np.where(cells[f"{side}_px_{i}"][1], sign * (px - whole[0]), 0) for i, px in enumerate(whole)])
        if (offset < INT32.min).any() or (offset > INT32.max).any():
            raise BlobError(f"{side}: a price is more than 32 bits from the best one")
        out.append(offset.astype("<i4").tobytes())
    out += [cells[f"{side}_sz_{i}"][0].astype("<f4").tobytes() for side in SIDES for i in range(depth)]
    return b"".join(out)


def compress(raw: bytes, level: int = 19) -> bytes:
    """One zstd stream; its frame names no size, as if it were written piece by piece."""
    if level not in LEVELS:
        raise BlobError(f"zstd has no level {level}")
    packer = zstandard.ZstdCompressor(level=level).compressobj()
    return packer.compress(raw) + packer.flush()


def expand(packed: bytes | BinaryIO, most: int = -1) -> bytes:
    """What a stream holds, or its first ``most`` bytes; of a file, no more is read than these need."""
    source = io.BytesIO(packed) if isinstance(packed, bytes) else packed
    try:
        with zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True, closefd=False) as reader:
            return reader.read(most)
    except zstandard.ZstdError as e:
        raise BlobError(f"no zstd stream: {e}") from e


def encode(table: pa.Table, scale: int = SCALE, level: int = 19) -> bytes:
    return compress(pack(table, scale), level)


class _Bytes:
    """Reads arrays off a blob in order."""

    def __init__(self, raw: bytes, at: int):
        self.raw, self.at = raw, at

    def take(self, kind: str, n: int) -> np.ndarray:
        size = np.dtype(kind).itemsize * n
        if self.at + size > len(self.raw):
            raise BlobError("the blob is cut off")
        self.at += size
        return np.frombuffer(self.raw, kind, n, self.at - size)

    def steps(self, rows: int) -> np.ndarray:
        """A 64-bit start and the running sums of 32-bit differences; an error where a sum leaves 64 bits."""
        start, total = self.take("<i8", 1), np.r_[0, np.cumsum(self.take("<i4", rows - 1).astype(np.int64))]
        if not INT64.min <= int(start[0]) + int(total.min()) <= int(start[0]) + int(total.max()) <= INT64.max:
            raise BlobError("a running sum of the blob leaves 64 bits")
        return start + total


def read_header(raw: bytes) -> tuple[dict, int]:
    """The checked header and where it ends."""
    if raw[:8] != MAGIC:
        raise BlobError("the bytes do not begin as a blob")
    size = int.from_bytes(raw[8:12], "little")
    if not 0 < size <= MOST_HEADER or len(raw) < 12 + size:
        raise BlobError(f"a header can't be {size} bytes long")
    try:
        head = json.loads(raw[12 : 12 + size])
    except ValueError as e:
        raise BlobError(f"the header is no JSON: {e}") from e
    if not isinstance(head, dict) or head.get("format") != FORMAT:
        raise BlobError("a blob of another format")
    for key, wrong in (("depth", head.get("depth") != DEPTH), ("rows", not isinstance(head.get("rows"), int) or head["rows"] <= 0), ("scale", not isinstance(head.get("scale"), int) or head["scale"] <= 0)):
        if wrong:
            raise BlobError(f"the header's {key} is {head.get(key)}")
    return head, 12 + size


def unpack(raw: bytes) -> pa.Table:
    """The sampled book of an uncompressed blob."""
    head, at = read_header(raw)
    rows, scale, names = head["rows"], head["scale"], book_columns()
    data = _Bytes(raw, at)
    present = {name: np.unpackbits(data.take("u1", (rows + 7) // 8), count=rows, bitorder="little").astype(bool) for name in names}
    times = data.steps(rows)
    values = {}
    for side, sign in zip(SIDES, (-1, 1), strict=True):
        base = data.steps(rows)
        offset = data.take("<i4", rows * DEPTH).reshape(rows, DEPTH).astype(np.int64)
        ends = [int(base.min()) + int(min(sign * offset.min(), sign * offset.max())), int(base.max()) + int(max(sign * offset.min(), sign * offset.max()))]
        if (ends[0] < INT64.min or ends[1] > INT64.max) and ((sign * offset > 0) & (base[:, None] > INT64.max - sign * offset) | (sign * offset < 0) & (base[:, None] < INT64.min - sign * offset)).any():
            raise BlobError(f"{side}: a restored price leaves 64 bits")
        for i in range(DEPTH):
            values[f"{side}_px_{i}"] = ((base + sign * offset[:, i]).astype(np.float64) / scale).astype(np.float32)
    for side in SIDES:
        for i in range(DEPTH):
            values[f"{side}_sz_{i}"] = data.take("<f4", rows)
    if data.at != len(raw):
        raise BlobError("bytes follow the blob's end")
    arrays = [pa.array(times, pa.int64()), *(pa.array(values[n], pa.float32(), mask=~present[n]) for n in names)]
    schema = pa.schema([pa.field("timestamp_ms", pa.int64(), nullable=False), *(pa.field(n, pa.float32()) for n in names)])
    return pa.Table.from_arrays(arrays, schema=schema)


def decode(packed: bytes) -> pa.Table:
    return unpack(expand(packed))


def inspect(packed: bytes | BinaryIO) -> dict:
    """rows, depth and scale, from the first bytes of the stream alone: its frame, then as many as the header says."""
    source = io.BytesIO(packed) if isinstance(packed, bytes) else packed
    try:
        with zstandard.ZstdDecompressor().stream_reader(source, read_size=4096, closefd=False) as reader:
            raw = reader.read(12)
            raw += reader.read(min(int.from_bytes(raw[8:12], "little"), MOST_HEADER))
    except zstandard.ZstdError as e:
        raise BlobError(f"no zstd stream: {e}") from e
    head, _ = read_header(raw)
    return {k: head[k] for k in ("rows", "depth", "scale")}


def same_bits(a: pa.Table, b: pa.Table, depth: int = DEPTH) -> int:
    """How many cells of two books differ in presence or in any bit."""
    (ta, ca), (tb, cb) = columns(a, depth), columns(b, depth)
    if len(ta) != len(tb):
        raise BlobError(f"books of {len(ta)} and {len(tb)} rows")
    out = int((ta != tb).sum())
    for name in book_columns(depth):
        (x, px), (y, py) = ca[name], cb[name]
        out += int(((px != py) | (px & py & (x.view(np.uint32) != y.view(np.uint32)))).sum())
    return out


def round_trip(books: DataFrame, scale: int = SCALE, level: int = 3) -> DataFrame:
    """Codes each day of sampled books to bytes and back: rows, bytes before and after zstd, and cells that differ."""
    schema = pa.schema([("symbol", pa.string()), ("trade_date", pa.date32()), ("rows", pa.int64()), ("raw_bytes", pa.int64()), ("differing_cells", pa.int64()), ("smaller", pa.bool_()), ("error", pa.string())])

    def day(table: pa.Table) -> pa.Table:
        table = table.sort_by("timestamp_ms")
        row = {"symbol": table["symbol"][0].as_py(), "trade_date": table["trade_date"][0].as_py(), "rows": table.num_rows}
        try:
            raw = pack(table, scale)
            packed = compress(raw, level)
            row |= {"raw_bytes": len(raw), "smaller": len(packed) < len(raw), "differing_cells": same_bits(table, decode(packed)) + (inspect(packed)["rows"] != table.num_rows)}
        except BlobError as e:  # a bad day fails alone
            row["error"] = str(e)
        return pa.Table.from_pylist([row], schema)

    return books.select(*DAY, "timestamp_ms", *book_columns()).groupBy(*DAY).applyInArrow(day, "symbol string, trade_date date, rows long, raw_bytes long, differing_cells long, smaller boolean, error string")


def column_time_blob(table: pa.Table, scale: int = SCALE) -> bytes:
    """The other experiment's bytes: every price column differenced down the rows, rounded half to even; no nulls."""
    times, cells = columns(table)
    prices = [n for n in book_columns() if n.startswith("bid_px")] + [n for n in book_columns() if n.startswith("ask_px")]
    sizes = [n for n in book_columns() if n.startswith("bid_sz")] + [n for n in book_columns() if n.startswith("ask_sz")]
    if not all(p.all() for _, p in cells.values()):
        raise BlobError("steps by column need a value in each cell")
    head = json.dumps({"format": "column_time_delta_v1", "rows": len(times), "scale": scale, "timestamp": "timestamp_ms", "price_cols": prices, "size_cols": sizes, "sizes": SIZES}, separators=(",", ":")).encode()
    out = [np.array([len(head)], "<u4").tobytes(), head, _steps(times, "timestamp")]
    out += [_steps(np.rint(cells[n][0].astype(np.float64) * scale).astype(np.int64), n) for n in prices]
    return b"".join(out + [cells[n][0].astype("<f4").tobytes() for n in sizes])


def batches_of(table: pa.Table, rows: int = 65_536) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches(max_chunksize=rows)
