"""Base-plus-offset delta coding of sampled books as column arithmetic.

Books are wide rows in the order of timestamp_ms inside each (symbol, trade_date). The best price of a
side is coded as differences down the rows, deeper prices as distances from it in whole numbers at a
scale; a price that the scale can't restore exactly makes the book unfit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from bookweave.functions.scalars import DEPTH, SCALE, scaled_price
from bookweave.operators.replay import DAY, SIDES, book_columns

INT32 = (-(2**31), 2**31 - 1)
# Fixed sizes in bytes: magic and header length; a 64-bit start; a 32-bit difference; a 32-bit size.
FRAME, START, STEP, CELL = 12, 8, 4, 4


def down() -> WindowSpec:
    """A day's rows in order of time."""
    return Window.partitionBy(*DAY).orderBy("timestamp_ms")


def codable(books: DataFrame) -> DataFrame:
    """Rows that have both best prices; the format can't hold others."""
    return books.where("bid_px_0 IS NOT NULL AND ask_px_0 IS NOT NULL")


def scaled(books: DataFrame, scale: int = SCALE, depth: int = DEPTH) -> DataFrame:
    """Day, timestamp_ms, and bid and ask: arrays of whole prices, null where there is no level or no exact value."""
    return books.select(*DAY, "timestamp_ms", *(F.array(*(scaled_price(F.col(f"{s}_px_{i}"), scale) for i in range(depth))).alias(s) for s in SIDES))


def differences(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the difference from the row before as name; null in a day's first row."""
    return rows.withColumn(name, F.col(column) - F.lag(column).over(down()))


def restored(rows: DataFrame, first: str, step: str, name: str) -> DataFrame:
    """The inverse: first in a day's first row and running sums of step after it."""
    start = F.first(first).over(down().rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, start + F.coalesce(F.sum(step).over(down().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))


def offsets(rows: DataFrame) -> DataFrame:
    """scaled rows to long: side, level, px, base, offset (towards the book's depth)."""

    def cells(side: str):
        base = F.get(side, F.lit(0))
        return F.transform(side, lambda px, i: F.struct(F.lit(side).alias("side"), base.alias("base"), i.alias("level"), px.alias("px"), (base - px if side == "bid" else px - base).alias("offset")))

    return rows.select(*DAY, "timestamp_ms", F.inline(F.concat(*map(cells, SIDES)))).where("px IS NOT NULL")


def fits(value: Column) -> Column:
    return value.isNull() | value.between(*INT32)


def unpack(long: DataFrame, scale: int = SCALE) -> DataFrame:
    """offsets' rows with price, restored from base and offset alone."""
    whole = F.when(F.col("side") == "bid", F.col("base") - F.col("offset")).otherwise(F.col("base") + F.col("offset"))
    return long.withColumn("price", (whole / F.lit(float(scale))).cast("float"))


def cells(books: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Wide books to long: column and value, with a row for each cell."""
    names = book_columns(depth)
    pairs = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.col(c).alias("value")) for i, c in enumerate(names)))
    return books.select(*DAY, "timestamp_ms", F.inline(pairs))


def present(books: DataFrame, depth: int = DEPTH) -> DataFrame:
    """For each day and column, the cells that its validity bitmap marks, and the bitmap's bytes."""
    found = cells(books, depth).groupBy(*DAY, "place", "column").agg(F.count("value").alias("present"), F.count("*").alias("rows"))
    return found.withColumn("bitmap_bytes", F.floor((F.col("rows") + 7) / 8).cast("long")).drop("place")


def header(depth: int, scale: int, rows: Column) -> Column:
    """The blob's JSON header."""
    names = lambda kind, sides: F.array(*(F.lit(f"{s}_{kind}_{i}") for s in sides for i in range(depth)))
    return F.to_json(F.struct(
        F.lit("base_offset_v1").alias("format"), rows.alias("rows"), F.lit(depth).alias("depth"), F.lit(scale).alias("scale"), F.lit("timestamp_ms").alias("timestamp"),
        names("px", ["bid"]).alias("bid_px_cols"), names("px", ["ask"]).alias("ask_px_cols"), names("sz", SIDES).alias("size_cols"),
        F.lit("raw_f32").alias("sizes"), F.lit("one_bitmap_per_f32_column").alias("null_bitmap"),
    ))


def blob_size(books: DataFrame, scale: int = SCALE, depth: int = DEPTH) -> DataFrame:
    """Bytes of each day's uncompressed blob: its frame and header, bitmaps, times, prices and sizes."""
    n = F.col("rows")
    head = F.length(header(depth, scale, n))
    bitmaps = 4 * depth * F.floor((n + 7) / 8)
    prices = 2 * (START + STEP * (n - 1) + STEP * depth * n)
    total = FRAME + head + bitmaps + START + STEP * (n - 1) + prices + 2 * depth * CELL * n
    return books.groupBy(*DAY).agg(F.count("*").alias("rows")).withColumn("header_bytes", head.cast("long")).withColumn("blob_bytes", total.cast("long"))


def _differing(a: pa.Array, b: pa.Array) -> pa.Array:
    """How many places of two columns of equally long float arrays differ in presence or in any bit; where one has no array, all of them."""
    there = np.asarray(a.is_valid()) & np.asarray(b.is_valid())
    width = max(pc.max(pc.list_value_length(x)).as_py() or 0 for x in (a, b))
    out = np.full(len(a), width, np.int32)
    (x, px), (y, py) = (_bits(c.filter(pa.array(there))) for c in (a, b))
    out[there] = ((px != py) | (px & py & (x != y))).reshape(int(there.sum()), -1).sum(1)
    return pa.array(out)


def _bits(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bits and the presence of all values of a float array column."""
    flat = column.flatten()
    return flat.fill_null(0.0).to_numpy(zero_copy_only=False).view(np.uint32), np.asarray(flat.is_valid())


def verify(left: DataFrame, right: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Cells of two books, row by row of each day, and how many differ in presence or in any bit; a row that one book lacks differs in all. Tables that Spark wrote have one NaN only."""
    number = F.row_number().over(down()).alias("_row")
    a, b = (x.select(*DAY, number, F.col("timestamp_ms").alias(f"{s}_ms"), F.array(*book_columns(depth)).alias(s)) for s, x in (("a", left), ("b", right)))
    both = a.join(b, [*DAY, "_row"], "full")
    if any(x.schema[s].dataType.elementType != T.FloatType() for s, x in (("a", a), ("b", b))):
        raise ValueError("a book's prices and sizes are 32-bit numbers")
    cells = (~F.col("a_ms").eqNullSafe(F.col("b_ms"))).cast("int") + F.arrow_udf(_differing, T.IntegerType())("a", "b")
    return both.select(*DAY, cells.alias("n")).groupBy(*DAY).agg(F.count("*").alias("rows"), F.sum("n").alias("differing_cells"))


def column_steps(books: DataFrame, scale: int = SCALE, depth: int = DEPTH) -> DataFrame:
    """The other experiment: each price column differenced down the rows, rounded half to even, with the range of its steps."""
    prices = [c for c in book_columns(depth) if "_px_" in c]
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.rint(F.col(c).cast("double") * scale).cast("long").alias("px")) for c in prices))
    long = books.select(*DAY, "timestamp_ms", F.inline(pairs))
    step = F.col("px") - F.lag("px").over(Window.partitionBy(*DAY, "column").orderBy("timestamp_ms"))
    found = long.withColumn("step", step).groupBy(*DAY, "column").agg(F.min("step").alias("least"), F.max("step").alias("greatest"))
    return found.withColumn("fits", fits(F.col("least")) & fits(F.col("greatest")))


def time_steps(books: DataFrame, first: int = 100_000, most: int = 16) -> DataFrame:
    """The least ``most`` distinct differences of the first times of each day."""
    rows = differences(books.select(*DAY, "timestamp_ms"), "timestamp_ms", "step").withColumn("n", F.row_number().over(down()))
    known = rows.where(f"step IS NOT NULL AND n <= {first + 1}").select(*DAY, "step").distinct()
    return known.withColumn("rank", F.row_number().over(Window.partitionBy(*DAY).orderBy("step"))).where(f"rank <= {most}")


def distance(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """For each column the greatest and mean absolute difference, root mean square and number of unequal cells."""
    pairs = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), (F.col(f"a.{c}").cast("double") - F.col(f"b.{c}").cast("double")).alias("d")) for i, c in enumerate(columns)))
    long = left.alias("a").join(right.alias("b"), keys).select(F.inline(pairs))
    gap = F.abs("d")
    return long.groupBy("place", "column").agg(
        F.max(gap).alias("max_abs"), F.avg(gap).alias("mean_abs"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"), F.count_if(F.col("d") != 0).alias("nonzero"), F.count("d").alias("cells")
    )


def totals(report: DataFrame) -> DataFrame:
    """All columns of a distance report together."""
    cells = F.sum("cells")
    return report.agg(
        F.count("*").alias("columns"), cells.alias("cells"), F.sum("nonzero").alias("nonzero"), F.max("max_abs").alias("max_abs"),
        (F.sum(F.col("mean_abs") * F.col("cells")) / cells).alias("mean_abs"), F.sqrt(F.sum(F.col("rmse") * F.col("rmse") * F.col("cells")) / cells).alias("rmse"),
    )


def worst(report: DataFrame, n: int = 10) -> DataFrame:
    """The columns of greatest difference, earlier columns first among equals."""
    return report.orderBy(F.desc("max_abs"), "place").limit(n)


def compression(sizes: DataFrame) -> DataFrame:
    """sizes: name, bytes, original. Adds mib, ratio and saved_pct."""
    ratio = F.col("bytes") / F.col("original")
    return sizes.withColumn("mib", F.col("bytes") / (1 << 20)).withColumn("ratio", ratio).withColumn("saved_pct", (1 - ratio) * 100)
