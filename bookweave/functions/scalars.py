"""Scalar expressions of the order-book model; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price scale, sampling interval and depth of the book format.
SCALE, SAMPLE_MS, DEPTH = 1_000_000, 100, 20
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"
LARGEST = 9223372036854775807


def _number(text: Column, type_: str) -> Column:
    """A decimal number; null where the text is none or the value is not finite."""
    value = F.when(text.rlike(NUMBER), text.try_cast(type_))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def price_key(text: Column) -> Column:
    """A price as a whole number of millionths, half away from zero; null unless finite and above 0."""
    value = _number(text, "double")
    scaled = F.round(value * SCALE)
    return F.when(value > 0, F.when(scaled >= float(LARGEST), F.lit(LARGEST)).otherwise(F.when(scaled < float(LARGEST), scaled).cast("long")))


def price(key: Column) -> Column:
    """The 32-bit price of a key."""
    return (key.cast("double") / F.lit(float(SCALE))).cast("float")


def quantity(text: Column) -> Column:
    """A quantity as a 32-bit number; null unless finite and not below 0."""
    value = _number(text, "float")
    return F.when(value >= 0, value)


def timestamp_ms(text: Column) -> Column:
    """A time in milliseconds; null where the text is no 64-bit integer."""
    return F.when(text.rlike(INTEGER), text.try_cast("long"))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without zone, rounded down."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", start, ts.cast("timestamp_ntz")) / 1000).cast("long")


def csv_field(text: Column) -> Column:
    """Quoted where it holds a comma, a quote or a line end; quotes are doubled."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\\n\\r]'), quoted).otherwise(text)


def scaled_price(value: Column, scale: int = SCALE) -> Column:
    """A 32-bit price times scale as a whole number; null unless that restores the price exactly."""
    whole = F.round(value.cast("double") * scale)
    back = (whole / F.lit(float(scale))).cast("float")
    return F.when((F.abs(whole) < float(LARGEST)) & (back == value), F.when(F.abs(whole) < float(LARGEST), whole).cast("long"))
