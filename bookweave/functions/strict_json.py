"""Strict reading of one order-book record from a JSON line.

``from_json`` takes numbers for strings, null for lists, repeated fields and trailing text; none of
these may pass. So it reads only lines of a plain form, in which nothing of the kind can be; all others
go to Python, a batch at a time.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("action", "ts", "bids", "asks")
RECORD = "struct<ok:boolean,action:string,ts:string,bids:array<array<string>>,asks:array<array<string>>>"

# A plain line: each field once, no space between, texts of printable ASCII without escapes. No part is ever
# given back (``*+``, ``?+``), so that long lines take no more stack than short ones.
_TEXT = r'"[ !#-\[\]-~]*+"'
_LEVEL = rf"\[(?:{_TEXT}(?:,{_TEXT})*+)?+\]"
_LEVELS = rf"\[(?:{_LEVEL}(?:,{_LEVEL})*+)?+\]"
_SIDES = "|".join(f'"{a}":{_LEVELS},"{b}":{_LEVELS}' for a, b in (("bids", "asks"), ("asks", "bids")))
PLAIN = rf'^\{{(?:"instId":{_TEXT},)?+"action":{_TEXT},"ts":{_TEXT},(?:{_SIDES})\}}\z'


class Bad(ValueError):
    pass


def _once(pairs: list[tuple[str, object]]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs) and any(sum(k == f for k, _ in pairs) > 1 for f in FIELDS):
        raise Bad("repeated field")
    return out


def _constant(name: str) -> None:
    raise Bad(name)


_decoder = json.JSONDecoder(object_pairs_hook=_once, parse_constant=_constant)


def _text(x: object) -> str:
    if not isinstance(x, str):
        raise Bad("not a string")
    x.encode()  # a lone surrogate is an error
    return x


def _levels(x: object) -> list[list[str]]:
    if not isinstance(x, list) or not all(isinstance(level, list) for level in x):
        raise Bad("not a list of lists")
    return [[_text(v) for v in level] for level in x]


def parse(line: str) -> dict | None:
    """The record, or None for a bad line. An array of the fields in order counts as a record; bids and asks may be missing."""
    try:
        x = _decoder.decode(line.strip(" \t\r\n"))
        if isinstance(x, list) and 2 <= len(x) <= 4:
            x = dict(zip(FIELDS, x, strict=False))
        if not isinstance(x, dict):
            raise Bad("not a record")
        return {"action": _text(x["action"]), "ts": _text(x["ts"]), "bids": _levels(x.get("bids", [])), "asks": _levels(x.get("asks", []))}
    except (ValueError, KeyError, RecursionError):
        return None


def parsed(lines: DataFrame) -> DataFrame:
    """lines: line and others. Adds ok, action, ts, bids and asks; empty lines are not counted and go."""
    types = pa.struct([("ok", pa.bool_()), ("action", pa.string()), ("ts", pa.string()), ("bids", pa.list_(pa.list_(pa.string()))), ("asks", pa.list_(pa.list_(pa.string())))])

    @F.arrow_udf(RECORD)
    def read(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else {"ok": (r := parse(x)) is not None} | (r or {}) for x in column.to_pylist()], types)

    others = [c for c in lines.columns if c != "line"]
    rows = lines.where("length(line) > 0").withColumn("_r", read(F.when(~F.col("line").rlike(PLAIN), F.col("line"))))
    # a generator, so that from_json runs once for a line and not for each field
    found = rows.select(*others, F.inline(F.array(F.coalesce("_r", F.from_json("line", RECORD.removeprefix("struct<").removesuffix(">").replace(":", " "))))))
    return found.withColumn("ok", F.coalesce("ok", F.lit(True)))  # no plain line has the field
