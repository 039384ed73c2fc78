"""The registered queries of the order-book side, over the driver's tables."""

from __future__ import annotations

from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookweave.functions.scalars import price, price_key, quantity
from bookweave.functions.strict_json import parsed
from bookweave.operators import day_checks, delta_blob, delta_columns, evaluation, fused, ledger, replay, tasks
from bookweave.operators.replay import DAY
from bookweave.plans import daily
from bookweave.session import settle, shared_dir
from bookweave.sources import archive, archive_writer, book_files, ledger_files
from bookweave.sources.events_view import event_lines, event_records, table

MINUTE, FIVE = 60_000, 300_000


def dbl(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


# --- parsing ---


def lob_parse_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_records(spark, sf_dir)
    level = lambda side, column: F.transform(column, lambda l, i: F.struct(F.lit(side).alias("side"), i.alias("pos"), price_key(F.get(l, F.lit(0))).alias("px_key"), quantity(F.get(l, F.lit(1))).cast("double").alias("qty")))
    return rows.select("seq", F.inline(F.concat(level("bid", "bids"), level("ask", "asks")))).where("px_key IS NOT NULL AND qty IS NOT NULL")


def lob_price_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "events").select(price_key(F.col("value").cast("string")).alias("px_key")).where("px_key IS NOT NULL")
    return keys.groupBy("px_key").agg(F.count("*").alias("n")).withColumn("price", price(F.col("px_key")).cast("double"))


def lob_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(event_lines(spark, sf_dir)).select("seq", "ok", "action", "ts", F.when(F.col("ok"), F.size("bids")).alias("n_bids"), F.when(F.col("ok"), F.size("asks")).alias("n_asks"))


def lob_ts_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.keep(event_records(spark, sf_dir, bad_ts=True)).select("seq", "ets", "pts")


def lob_ts_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled seq repeats from 100,003 events on; events of one seq follow their event_id."""
    order = ("seq", "event_id")
    return replay.regressions(replay.keep(event_records(spark, sf_dir, shuffled=True), order), order)


# --- replay ---


def lob_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.epochs(event_records(spark, sf_dir, first_snapshot=False)).select(*DAY, "seq", "epoch")


def lob_leading_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay.epochs(event_records(spark, sf_dir, first_snapshot=False))
    return rows.groupBy(*DAY).agg(F.count_if(F.col("epoch") == 0).alias("dropped"), F.count_if(F.col("epoch") > 0).alias("kept"), F.min(F.when(F.col("epoch") > 0, F.col("seq"))).alias("first_seq"))


def lob_level_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several levels with repeated prices: the orders of a customer and priority, in order of their keys."""
    orders = table(spark, sf_dir, "orders")
    level = F.struct("o_orderkey", F.array(F.floor(F.col("o_totalprice") / 50_000).cast("string"), F.pmod("o_orderkey", F.lit(3)).cast("string")).alias("l"))
    rows = orders.groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_custkey").alias("seq")).agg(F.sort_array(F.collect_list(level)).alias("v"))
    none = F.array().cast("array<array<string>>")
    records = rows.select("symbol", F.lit(None).cast("date").alias("trade_date"), "seq", F.lit(1).alias("epoch"), F.when(F.pmod("seq", F.lit(2)) == 0, "snapshot").otherwise("update").alias("action"), F.transform("v", lambda x: x["l"]).alias("bids"), none.alias("asks"))
    return replay.levels(records).select("symbol", "seq", "side", "px_key", F.col("qty").cast("double").alias("qty"), "pos")


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.intervals(replay.levels(replay.keep(event_records(spark, sf_dir))))


def lob_level_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intervals(spark, sf_dir).select(*DAY, "epoch", "side", "px_key", "seq", "next_seq", *dbl("qty"))


def lob_topk_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = replay.flagged_days(replay.keep(event_records(spark, sf_dir)))
    return fused.long(fused.ladders(kept, MINUTE)).select(*DAY, "seq", "side", "level", "px_key", *dbl("qty"))


def lob_topk_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the sampled book, twenty levels a side."""
    return fused.samples(event_records(spark, sf_dir), FIVE).select(*DAY, "timestamp_ms", *dbl(*replay.book_columns()))


def lob_topk_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by joins and windows alone."""
    return replay.samples(event_records(spark, sf_dir), FIVE).select(*DAY, "timestamp_ms", *dbl(*replay.book_columns()))


def lob_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.spread(replay.triggers(replay.flagged_days(replay.keep(event_records(spark, sf_dir))), MINUTE).drop("epoch"), MINUTE)


def lob_day_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = replay.keep(event_records(spark, sf_dir))
    ends = kept.groupBy(*DAY).agg(day_checks.expected_rows(F.min("ets"), F.max("ets"), MINUTE).alias("expected"))
    counted = replay.triggers(kept, MINUTE).groupBy(*DAY).agg(F.sum(F.col("last_grid") - F.col("first_grid") + 1).alias("n"))
    rows = F.coalesce("n", F.lit(0))
    return ends.join(counted, DAY, "left").select(*DAY, rows.alias("sampled"), "expected", (rows == F.col("expected")).alias("same"))


def lob_best_quote_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fused.samples(event_records(spark, sf_dir), MINUTE, depth=1)
    bid, ask = F.col("bid_px_0").cast("double"), F.col("ask_px_0").cast("double")
    return rows.select(*DAY, "timestamp_ms", bid.alias("bid_px_0"), ask.alias("ask_px_0"), (ask - bid).alias("spread"), ((ask + bid) / 2).alias("mid"))


def lob_bad_line_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_checks.bad_lines(parsed(event_lines(spark, sf_dir)))


def lob_schema_rows_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = replay.keep(event_records(spark, sf_dir))
    books = replay.spread(_books(spark, sf_dir), FIVE)
    errors = len(day_checks.schema_errors(books))
    lacking = len(day_checks.schema_errors(books.select("timestamp_ms")))
    ends = kept.groupBy(*DAY).agg(day_checks.expected_rows(F.min("ets"), F.max("ets"), FIVE).alias("n")).agg(F.sum("n").alias("expected"))
    return books.agg(F.count("*").alias("rows")).join(ends).select("rows", "expected", F.lit(errors).alias("errors"), F.lit(lacking).alias("errors_without_prices"))


# --- delta coding, over the book at each five-minute trigger ---


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fused.sampled_books(event_records(spark, sf_dir), FIVE)


def _codable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delta_columns.codable(_books(spark, sf_dir))
    return rows.withColumn("timestamp_ms", F.col("last_grid") * FIVE).drop("seq", "first_grid", "last_grid")


def delta_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delta_columns.differences(_codable(spark, sf_dir).select(*DAY, "timestamp_ms"), "timestamp_ms", "step")
    rows = rows.withColumn("first", F.when(F.col("step").isNull(), F.col("timestamp_ms")))
    return delta_columns.restored(rows, "first", "step", "restored").withColumn("fits", delta_columns.fits(F.col("step"))).drop("first")


def delta_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delta_columns.scaled(_codable(spark, sf_dir)).select(*DAY, "timestamp_ms", F.get("bid", F.lit(0)).alias("bid"), F.get("ask", F.lit(0)).alias("ask"))
    for side in replay.SIDES:
        rows = delta_columns.differences(rows, side, f"{side}_step")
    return rows


def delta_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_columns.offsets(delta_columns.scaled(_codable(spark, sf_dir))).select(*DAY, "timestamp_ms", "side", "level", "base", "offset")


def delta_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_columns.unpack(delta_columns.offsets(delta_columns.scaled(_codable(spark, sf_dir)))).select(*DAY, "timestamp_ms", "side", "level", *dbl("price"))


def delta_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book against itself with every fifth best bid size changed."""
    books = settle(_codable(spark, sf_dir))  # replayed once
    other = books.withColumn("bid_sz_0", F.when(F.col("timestamp_ms") / FIVE % 5 == 0, F.col("bid_sz_0") + F.lit(1).cast("float")).otherwise(F.col("bid_sz_0")))
    return delta_columns.verify(books, other)


def delta_null_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_columns.present(_codable(spark, sf_dir))


def delta_blob_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_columns.blob_size(_codable(spark, sf_dir))


def delta_column_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_columns.column_steps(_codable(spark, sf_dir))


def delta_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten columns that coding at a hundredth of a price unit moves most."""
    books = settle(_codable(spark, sf_dir))  # replayed once
    coarse = books.withColumns({c: (F.rint(F.col(c).cast("double") * 100) / 100).cast("float") for c in replay.book_columns() if "_px_" in c})
    found = delta_columns.distance(books, coarse, [*DAY, "timestamp_ms"], replay.book_columns())
    return delta_columns.worst(found.where("cells > 0")).select("column", F.round("max_abs", 9).alias("max_abs"), F.round("mean_abs", 9).alias("mean_abs"), F.round("rmse", 9).alias("rmse"), "nonzero", "cells")


def delta_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each day's blob against its cells as plain 64-bit and 32-bit numbers."""
    sizes = delta_columns.blob_size(_codable(spark, sf_dir)).withColumn("original", F.col("rows") * (8 + 80 * 4))
    return delta_columns.compression(sizes.select(*DAY, F.col("blob_bytes").alias("bytes"), "original"))


def delta_blob_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day coded to bytes, decoded and compared bit by bit."""
    return delta_blob.round_trip(_codable(spark, sf_dir))


# --- tasks and ledger, from orders ---


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    kind = F.element_at(F.array(*map(F.lit, ledger.KINDS)), (F.pmod("o_orderkey", F.lit(5)) + 1).cast("int"))
    reason = F.concat(F.lit("status "), "o_orderstatus", F.lit(', retry "exhausted"'))
    return rows.select(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("trade_date"), F.col("o_orderkey").alias("seq"), kind.alias("kind"), reason.alias("reason"), F.col("o_custkey").alias("rows"), "o_orderstatus", "o_totalprice")


def task_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _orders(spark, sf_dir).groupBy("symbol").agg(F.min("trade_date").alias("a"), F.date_add(F.min("trade_date"), F.size(F.collect_set("o_orderstatus")) * 10 - 1).alias("b"))
    return spans.select("symbol", F.explode(F.sequence("a", "b")).alias("trade_date")).union(tasks.date_range(spans, F.lit("2024-01-30").cast("date"), F.lit("2024-02-02").cast("date")))


def task_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    return tasks.lookback(symbols, F.lit("2024-03-02").cast("date"), 3)


def task_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n = _orders(spark, sf_dir), F.pmod("seq", F.lit(7))
    day = F.date_format("trade_date", "yyyy-MM-dd")
    line = F.when(n == 0, F.lit(" \t\u3000")).when(n == 1, F.concat(F.lit("\t# "), "symbol")).when(n == 2, F.concat("symbol", F.lit(","), day)).when(n == 3, F.concat(F.lit(" :"), day)).when(n == 4, F.concat("symbol", F.lit(":2024-99-99"))).when(n == 5, F.concat("symbol", F.lit(" :\t"))).otherwise(F.concat(F.lit("\t"), "symbol", F.lit("\u00a0:\t"), day, F.lit("\u2003")))
    return tasks.targets(rows.select(F.col("seq").alias("line_no"), line.alias("line")))


def task_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("symbol", "trade_date").distinct().withColumn("url", tasks.archive_url(F.col("symbol"), F.col("trade_date")))


STATE = ("download", "process", "download_attempts", "process_attempts", "rows", "raw_deleted", "last_error", "downloaded", "not_available", "processed", "validated", "raw_present", "parquet_present", "task_status")


def ledger_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.fold(_orders(spark, sf_dir)).select(*ledger.TASK, *STATE)


def ledger_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (F.pmod(n, F.lit(len(names))) + 1).cast("int"))
    rows = _orders(spark, sf_dir).select("seq", pick(("pending", "success", "not_available", "failed"), F.col("seq")).alias("download"), pick(("pending", "success", "failed"), F.floor(F.col("seq") / 4)).alias("process"), (F.pmod("rows", F.lit(2)) == 0).alias("raw_deleted"))
    return ledger.normalized(rows)


def ledger_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    bit = lambda c, m: F.when(F.pmod(c, F.lit(m)) < m - 1, F.pmod(c, F.lit(m)) == 0)
    rows = _orders(spark, sf_dir)
    old = rows.select(F.col("seq").cast("string").alias("symbol"), "trade_date", bit("seq", 3).alias("downloaded"), bit("seq", 7).alias("not_available"), bit("rows", 5).alias("processed"), bit("rows", 11).alias("validated"), bit("rows", 4).alias("raw_deleted"), F.when(F.col("seq") % 2 == 0, F.pmod("rows", F.lit(3))).alias("download_attempts"), "rows")
    return ledger.from_legacy(old)


def ledger_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir)
    wanted = rows.select(*ledger.TASK).distinct()
    day = F.day("trade_date")
    files = wanted.select(*ledger.TASK, (day % 2 == 0).alias("raw"), (day % 3 == 0).alias("parquet"))
    return ledger.route(wanted, ledger.fold(rows.where("seq % 4 <> 0")), files)


def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir)
    wanted = rows.groupBy(*ledger.TASK).agg(F.min("seq").alias("n"))
    return ledger.summary(wanted, ledger.fold(rows))


def ledger_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.report(ledger.fold(_orders(spark, sf_dir)))


def retry_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("seq", F.pmod("seq", F.lit(8)).alias("attempt")).withColumn("wait_s", tasks.backoff_seconds(F.col("attempt")))


def not_available_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("seq", tasks.not_available(F.col("trade_date"), F.lit("1996-06-30").cast("date")).alias("outcome"))


def raw_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = F.element_at(F.array(*map(F.lit, (".tar.gz", ".tmp", ".parquet"))), (F.pmod("seq", F.lit(3)) + 1).cast("int"))
    return tasks.raw_usage(_orders(spark, sf_dir).select(F.concat("symbol", F.lit("/"), F.col("seq").cast("string"), ends).alias("path"), F.floor("o_totalprice").cast("long").alias("length")))


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written from the events' lines, one for each day, and read again."""
    root = archive_writer.write(event_lines(spark, sf_dir))
    lines = archive.read_archives(spark, root)
    return parsed(lines.where("error IS NULL").drop("error")).groupBy(*DAY).agg(F.count("*").alias("lines"), F.count_if("ok").alias("good"), F.max("seq").alias("last_seq"))


def archive_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of which some are cut off, empty or no archives, by the day of the month; their lines until then, and whether they are whole."""

    def change(symbol: str, day: date, data: bytes) -> bytes:
        return (data, data[:-8], b"", b"no archive")[day.day % 4]

    lines = archive.read_archives(spark, archive_writer.write(event_lines(spark, sf_dir), change=change))
    return lines.groupBy(*DAY).agg(F.count("line").alias("lines"), F.count("error").alias("errors"))


def lob_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some are empty (not counted) or blank (bad)."""
    n = F.col("seq")
    lines = event_lines(spark, sf_dir).withColumn("line", F.when(n % 11 == 0, "").when(n % 13 == 0, "  ").otherwise(F.col("line")))
    return parsed(lines).groupBy(*DAY).agg(F.count("*").alias("lines"), F.count_if("ok").alias("good"))


# --- books and blobs as files ---


def _day_files(books: DataFrame) -> str:
    """Writes each day's book; returns their folder."""
    root = shared_dir(books.sparkSession, "books")
    book_files.write_days(books, root).collect()  # a row for each day
    return root


def _blob_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    books, blobs = _day_files(_codable(spark, sf_dir)), shared_dir(spark, "blobs")
    book_files.encode_tree(spark, books, blobs, level=3).collect()  # a row for each day
    return books, blobs


def _of_path(path: str) -> list[Column]:
    parts = F.split(path, "/")
    return [F.element_at(parts, -2).alias("symbol"), F.substring(F.element_at(parts, -1), 1, 10).cast("date").alias("trade_date")]


def book_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled books, written as one file for each day straight from the replay and read again."""
    root = shared_dir(spark, "books")
    book_files.write_sorted_days(fused.samples(event_records(spark, sf_dir), FIVE), root).collect()  # a row for each day
    return day_checks.require_book(book_files.scan_books(spark, root)).select(*DAY, "timestamp_ms", *dbl(*replay.book_columns()))


def blob_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The books at the triggers, written, coded to blobs and read from these."""
    _, blobs = _blob_files(spark, sf_dir)
    return book_files.scan_blobs(spark, blobs).select(*_of_path("path"), "timestamp_ms", *dbl(*replay.book_columns()))


def blob_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, blobs = _blob_files(spark, sf_dir)
    return book_files.scan_headers(spark, blobs).select(*_of_path("input"), "rows", "depth", "scale")


def blob_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's book coded, coded again (left as it is), copied, decoded and compared with its blob."""
    books, blobs = _blob_files(spark, sf_dir)
    copies, back = shared_dir(spark, "copies"), shared_dir(spark, "back")
    steps = {
        "again": book_files.encode_tree(spark, books, blobs, level=3), "copied": book_files.copy_tree(spark, blobs, copies),
        "decoded": book_files.decode_tree(spark, blobs, back), "compared": book_files.verify_tree(spark, books, blobs),
    }
    out = None
    for name, done in steps.items():
        one = settle(done.select(*_of_path("input"), F.col("status").alias(name)))
        out = one if out is None else out.join(one, DAY, "full")
    restored = book_files.scan_books(spark, back).groupBy(*DAY).agg(F.count("*").alias("rows"))
    return out.join(restored, DAY, "full")


def delta_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books and blobs spoilt in one of eight ways, or none, by the day of the month; whether coding or decoding refuses them."""
    schema = pa.schema([("symbol", pa.string()), ("trade_date", pa.date32()), ("spoilt", pa.string()), ("refused", pa.bool_())])
    names = ["no", "null best price", "inexact price", "wide step", "null time", "magic", "cut", "longer", "overflow"]

    def day(table: pa.Table) -> pa.Table:
        table = table.sort_by("timestamp_ms")
        symbol, at = table["symbol"][0].as_py(), table["trade_date"][0].as_py()
        kind, refused = names[at.day % len(names)], False
        put = lambda t, name, value: t.set_column(t.schema.get_field_index(name), name, pa.array([value, *t[name].to_pylist()[1:]], t.schema.field(name).type))
        if kind == "wide step":
            table = pa.concat_tables([put(table.slice(0, 1), "timestamp_ms", -(2**40)), table])
        change = {"null best price": ("bid_px_0", None), "inexact price": ("ask_px_0", 0.1234567), "null time": ("timestamp_ms", None)}.get(kind)
        table = put(table, *change) if change else table
        try:
            raw = delta_blob.pack(table)
            start = 12 + int.from_bytes(raw[8:12], "little") + 80 * ((table.num_rows + 7) // 8)
            raw = {"magic": b"?" + raw[1:], "cut": raw[:-1], "longer": raw + b"?", "overflow": raw[:start] + (2**63 - 1).to_bytes(8, "little") + raw[start + 8 :]}.get(kind, raw)
            delta_blob.decode(delta_blob.compress(raw, 1))
        except delta_blob.BlobError:
            refused = True
        return pa.Table.from_pylist([{"symbol": symbol, "trade_date": at, "spoilt": kind, "refused": refused}], schema)

    return _codable(spark, sf_dir).select(*DAY, "timestamp_ms", *replay.book_columns()).groupBy(*DAY).applyInArrow(day, "symbol string, trade_date date, spoilt string, refused boolean")


def delta_time_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_columns.time_steps(_codable(spark, sf_dir))


def _full_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books without nulls, as the experiments need them: what a book lacks is 0."""
    return _codable(spark, sf_dir).select(*DAY, "timestamp_ms", *(F.coalesce(F.col(c), F.lit(0.0).cast("float")).alias(c) for c in replay.book_columns()))


def delta_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six forms of each day's book; bytes where the form fixes them, and whether zstd makes a form smaller."""
    schema = pa.schema([("symbol", pa.string()), ("trade_date", pa.date32()), ("name", pa.string()), ("bytes", pa.float64()), ("some", pa.bool_())])

    def day(table: pa.Table) -> pa.Table:
        table = table.sort_by("timestamp_ms")
        key = {c: table[c][0].as_py() for c in DAY}
        table = table.drop_columns(DAY)
        rows = evaluation.sizes(book_files.parquet_bytes(table), table, level=3)
        return pa.Table.from_pylist([key | {"name": r["name"], "bytes": float(r["bytes"]) if r["name"] in evaluation.FORMS[1:] else None, "some": r["bytes"] > 0 and r["mib"] == r["bytes"] / 2**20} for r in rows], schema)

    return _full_books(spark, sf_dir).groupBy(*DAY).applyInArrow(day, "symbol string, trade_date date, name string, bytes double, some boolean")


def delta_restored_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day coded as base and offsets, restored as a Parquet file and compared with the original bit by bit."""
    schema = pa.schema([("symbol", pa.string()), ("trade_date", pa.date32()), ("rows", pa.int64()), ("differing_cells", pa.int64())])

    def day(table: pa.Table) -> pa.Table:
        table = table.sort_by("timestamp_ms")
        back = evaluation.read_base_offset(evaluation.base_offset_blob(table))
        back = book_files.pq.read_table(pa.BufferReader(book_files.parquet_bytes(back)))
        return pa.Table.from_pylist([{c: table[c][0].as_py() for c in DAY} | {"rows": back.num_rows, "differing_cells": delta_blob.same_bits(table, back)}], schema)

    return _full_books(spark, sf_dir).groupBy(*DAY).applyInArrow(day, "symbol string, trade_date date, rows long, differing_cells long")


# --- the run and its files ---


def task_load_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines only; repeated targets once, in order."""
    rows = _orders(spark, sf_dir)
    lines = rows.select(F.col("seq").alias("line_no"), F.concat(F.lit("\t"), "symbol", F.lit(" : "), F.date_format("trade_date", "yyyy-MM-dd"), F.lit(" ")).alias("line"))
    return tasks.load_targets(lines)


def task_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.date_add("trade_date", (F.pmod("rows", F.lit(5)) - 2).cast("int"))
    return _orders(spark, sf_dir).select("seq", tasks.in_order(F.col("trade_date"), end).alias("ok"))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' events with a task for each symbol and month."""
    return _orders(spark, sf_dir).withColumn("trade_date", F.trunc("trade_date", "month").cast("date"))


def ledger_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States written as a file each, and read again with those of tasks that have no file."""
    events, root = _monthly(spark, sf_dir), shared_dir(spark, "ledger")
    ledger_files.write_states(ledger.fold(events.where("month(trade_date) <> 1")), root)
    return ledger_files.read_states(spark, root, events).select(*ledger.TASK, *STATE)


def ledger_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three events of each task, each read from, applied to and written to its file in turn."""
    place = F.row_number().over(Window.partitionBy(*ledger.TASK).orderBy("seq"))
    events, root = settle(_monthly(spark, sf_dir).withColumn("n", place).where("n <= 3")), shared_dir(spark, "ledger")
    for n in (1, 2, 3):
        daily.update(spark, root, events.where(F.col("n") == n))
    return ledger_files.read_states(spark, root, events).select(*ledger.TASK, *STATE)


def file_clean_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of finished and unfinished files after the clean-up, and after one file of each symbol is removed with its unfinished form."""
    root = shared_dir(spark, "files")
    for name in [r.symbol for r in _orders(spark, sf_dir).select("symbol").distinct().collect()]:  # a row for each symbol
        for end, size in ((".parquet", 3), (".parquet.tmp", 2), (".tar.gz", 5), (".tar.gz.tmp", 1), (".json", 7)):
            book_files.publish(f"{root}/{name}/2024-01-02{end}", b"x" * size)
        ledger_files.remove(f"{root}/{name}/2024-01-02.tar.gz")
    ledger_files.clean_up(root)
    return ledger_files.sizes(spark, root).select(F.element_at(F.split("path", "/"), -2).alias("symbol"), F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over all days: archives published for all but every fifth, replayed, checked and written; how each task ended."""
    published = archive_writer.write(event_lines(spark, sf_dir))
    roots = [shared_dir(spark, kind) for kind in ("raw", "books", "ledger")]

    def fetch(symbol: str, day: date, path: str) -> bool:
        if day.day % 5 == 0:
            return False
        book_files.publish(path, book_files.read_bytes(book_files.day_path(published, symbol, day, archive.SUFFIX)))
        return True

    days = event_records(spark, sf_dir).select(*DAY).distinct()
    todo = [tuple(r) for r in days.orderBy(*DAY).collect()]  # a row for each day
    config = daily.Config(*roots, tries=0, retries=0, retry_delay_s=0, cutoff=date(2100, 1, 1), sample_ms=FIVE, raw_max_bytes=1 << 30)
    daily.run(spark, todo, config, fetch)
    states = ledger_files.read_states(spark, config.ledger_root, days)
    return states.select(*DAY, F.col("task_status").alias("status"), F.col("rows").cast("double").alias("rows"), "download_attempts", "process_attempts", "raw_present")


QUERIES = {f.__name__: f for f in (
    lob_parse_levels, lob_price_keys, lob_json_records, lob_ts_carry, lob_ts_regressions, lob_epochs, lob_leading_drop, lob_level_dedupe, lob_level_intervals,
    lob_topk_long, lob_topk_wide, lob_topk_joined, lob_grid, lob_day_rowcount, lob_best_quote_samples, lob_bad_line_ratio, lob_schema_rows_check,
    delta_ts, delta_base, delta_offsets, delta_restore, delta_verify, delta_null_bitmap, delta_blob_size, delta_column_time, delta_distance, delta_compression, delta_blob_roundtrip,
    task_range, task_lookback, task_targets, task_urls, ledger_status, ledger_legacy, ledger_fold, ledger_routing, ledger_summary, ledger_report, retry_backoff, not_available_cutoff, raw_usage, archive_scan,
    archive_checks, lob_line_filter, book_files_scan, blob_files_scan, blob_headers, blob_transfer, delta_errors, delta_time_sample, delta_forms, delta_restored_book,
    task_load_targets, task_bounds, ledger_files_scan, ledger_updates, file_clean_up, daily_run,
)}
