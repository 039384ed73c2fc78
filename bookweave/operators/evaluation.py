"""The coding experiments on one book: sizes of six forms, and how far a restored book is from the original.

The plain base-offset form here differs from the delta format: no magic number, no validity bitmaps, so
no nulls, and prices are rounded half to even without a check that they restore exactly.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from bookweave.functions.scalars import DEPTH, SCALE
from bookweave.operators.delta_blob import FORMAT, INT32, SIZES, BlobError, _Bytes, _steps, column_time_blob, columns, compress
from bookweave.operators.replay import SIDES, book_columns

# How the header names the two kinds of offset.
OFFSETS = {"bid_offsets": "bid_px_0_minus_bid_px_i_i32", "ask_offsets": "ask_px_i_minus_ask_px_0_i32"}


def base_offset_blob(table: pa.Table, scale: int = SCALE) -> bytes:
    """Times, then for each side its best prices and offsets, then sizes."""
    times, cells = columns(table)
    if not len(times) or not all(present.all() for _, present in cells.values()):
        raise BlobError("base and offsets need rows and a value in each cell")
    names = lambda kind, sides: [f"{s}_{kind}_{i}" for s in sides for i in range(DEPTH)]
    head = {"format": FORMAT, "rows": len(times), "depth": DEPTH, "scale": scale, "timestamp": "timestamp_ms", "bid_px_cols": names("px", ["bid"]), "ask_px_cols": names("px", ["ask"]), "size_cols": names("sz", SIDES), "sizes": SIZES} | OFFSETS
    text = json.dumps(head, separators=(",", ":")).encode()
    out = [len(text).to_bytes(4, "little"), text, _steps(times, "timestamp")]
    for side, sign in zip(SIDES, (-1, 1), strict=True):
        whole = np.column_stack([np.rint(cells[f"{side}_px_{i}"][0].astype(np.float64) * scale).astype(np.int64) for i in range(DEPTH)])
        offset = sign * (whole - whole[:, :1])
        if offset.min() < INT32.min or offset.max() > INT32.max:
            raise BlobError(f"{side}: a price is more than 32 bits from the best one")
        out += [_steps(whole[:, 0], f"{side} base"), offset.astype("<i4").tobytes()]
    return b"".join(out + [cells[n][0].astype("<f4").tobytes() for n in names("sz", SIDES)])


def read_base_offset(raw: bytes) -> pa.Table:
    """The book of such a blob."""
    size = int.from_bytes(raw[:4], "little")
    head = json.loads(raw[4 : 4 + size]) if size else {}
    if head.get("format") != FORMAT:
        raise BlobError(f"bytes of format {head.get('format')}")
    rows, scale, data, values = head["rows"], head["scale"], _Bytes(raw, 4 + size), {}
    times = data.steps(rows)
    for side, sign in zip(SIDES, (-1, 1), strict=True):
        base = data.steps(rows)
        offset = data.take("<i4", rows * DEPTH).reshape(rows, DEPTH).astype(np.int64)
        for i in range(DEPTH):
            values[f"{side}_px_{i}"] = ((base + sign * offset[:, i]).astype(np.float64) / scale).astype(np.float32)
    for name in head["size_cols"]:
        values[name] = data.take("<f4", rows)
    if data.at != len(raw):
        raise BlobError("bytes follow the book's end")
    return pa.table({"timestamp_ms": times, **{n: pa.array(values[n], pa.float32()) for n in book_columns()}})


FORMS = ("book", "steps by column", "base and offsets")


def sizes(packed: bytes, table: pa.Table, scale: int = SCALE, level: int = 19) -> list[dict]:
    """packed: the book's Parquet file. Bytes, MiB, share and saving of six forms: the file, the two codings, and each of them under zstd."""
    raw = dict(zip(FORMS, (packed, column_time_blob(table, scale), base_offset_blob(table, scale)), strict=True))
    forms = [(name + end, size) for name, data in raw.items() for end, size in (("", len(data)), (f", zstd {level}", len(compress(data, level))))]
    return [{"name": n, "bytes": b, "mib": b / (1 << 20), "ratio": b / len(packed), "saved_pct": (1 - b / len(packed)) * 100} for n, b in forms]
