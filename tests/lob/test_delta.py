"""The delta format: bytes, columns and files."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bookweave.operators import delta_blob as blob
from bookweave.operators import delta_columns, evaluation, replay
from bookweave.sources import book_files
from pyspark.sql import functions as F

NAMES = replay.book_columns()


def sample(rows=4, **changes):
    r, cells = np.arange(rows, dtype=np.float32), {"timestamp_ms": pa.array(1_700_000_000_000 + 100 * np.arange(rows))}
    f = np.float32
    for name in NAMES:
        side, kind, i = name.split("_")
        start, per_level, per_row = {"bidpx": (100.0, -0.1, 0.01), "bidsz": (1.0, 0.01, 0.001), "askpx": (100.5, 0.1, 0.01), "asksz": (2.0, 0.01, 0.001)}[side + kind]
        cells[name] = pa.array((f(start) + f(per_level) * f(int(i)) + f(per_row) * r).astype(f), pa.float32())
    return pa.table(cells | {k: pa.array(v, pa.int64() if k == "timestamp_ms" else pa.float32()) for k, v in changes.items()})


def test_round_trip_and_inspect():
    table = sample()
    packed = blob.encode(table, level=3)
    assert blob.same_bits(table, blob.decode(packed)) == 0 and blob.inspect(packed) == {"rows": 4, "depth": 20, "scale": 1_000_000}
    assert len(blob.pack(table)) == 12 + len(blob.json.dumps(blob.header(4, 1_000_000), separators=(",", ":"))) + 80 + 8 + 12 + 2 * (8 + 12 + 320) + 640


def test_nulls_nan_and_negative_zero_survive():
    table = sample(3, bid_px_7=[None, 99.25, None], bid_sz_7=[None, float("nan"), -0.0], ask_sz_0=[0.0, -0.0, None])
    back = blob.decode(blob.encode(table))
    assert blob.same_bits(table, back) == 0 and back["bid_px_7"].null_count == 2
    assert blob.same_bits(table, blob.decode(blob.encode(sample(3, bid_px_7=[None, 99.25, None], bid_sz_7=[None, 1.0, 0.0], ask_sz_0=[0.0, 0.0, None])))) == 3


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2_000_000_000), st.integers(0, 2_000), st.floats(0, 1e6, width=32)), min_size=1, max_size=20))
def test_random_books_survive(rows):
    price = lambda k: float(np.float32(k / 1e6))
    table = sample(len(rows), ask_px_0=[price(k + 10_000) for k, _, _ in rows], bid_px_0=[price(k) for k, _, _ in rows], bid_px_3=[price(k) if g % 2 else None for k, g, _ in rows], ask_sz_5=[z for _, _, z in rows])
    try:
        raw = blob.pack(table)
    except blob.BlobError as e:
        assert "32 bits" in str(e) or "bit by bit" in str(e)
    else:
        assert blob.same_bits(table, blob.unpack(raw)) == 0


@pytest.mark.parametrize(("table", "why"), [
    (sample().select(["timestamp_ms"]), "lacks column"),
    (sample().set_column(1, "bid_px_0", pa.array([1.0] * 4)), "is double"),
    (sample(2, bid_px_0=[100.0, None]), "row 1 has no best bid"),
    (sample(2, ask_px_4=[0.1234567, 101.0]), "bit by bit"),
    (sample(2, ask_px_4=[float("inf"), 101.0]), "not a finite"),
    (sample(2, bid_px_0=[100.0, 2300.0]), "32 bits"),
    (sample(2, timestamp_ms=[0, 2**31]), "32 bits"),
    (sample(2, timestamp_ms=[0, None]), "null"),
    (sample(0), "without rows"),
])
def test_unfit_books(table, why):
    with pytest.raises(blob.BlobError, match=why):
        blob.encode(table)


def test_unfit_bytes():
    raw = blob.pack(sample())
    cases = [b"x" + raw[1:], raw[:8] + b"\0\0\0\0" + raw[12:], raw.replace(b'"depth":20', b'"depth":10'), raw.replace(b'"rows":4', b'"rows":0'), raw.replace(b'"scale":1000000', b'"scale":0000000'), raw.replace(b"base_offset_v1", b"base_offset_v2"), raw + b"x", raw[:-1]]
    for bad in cases:
        with pytest.raises(blob.BlobError):
            blob.unpack(bad)
    with pytest.raises(blob.BlobError, match="zstd"):
        blob.decode(b"not a stream")
    for args in ((sample(), 0, 3), (sample(), 1, 0), (sample(), 1, 23)):
        with pytest.raises(blob.BlobError):
            blob.encode(*args)


def test_column_time_blob_and_its_limits():
    raw = blob.column_time_blob(sample())
    assert raw[4:].startswith(b'{"format":"column_time_delta_v1","rows":4') and len(raw) == 4 + int.from_bytes(raw[:4], "little") + 20 + 40 * 20 + 40 * 16
    with pytest.raises(blob.BlobError):
        blob.column_time_blob(sample(2, bid_sz_3=[None, 1.0]))


def test_experiments():
    table = sample(50)
    raw = evaluation.base_offset_blob(table)
    assert blob.same_bits(table, evaluation.read_base_offset(raw)) == 0
    packed = book_files.parquet_bytes(table)
    rows = evaluation.sizes(packed, table, level=3)
    assert [r["name"] for r in rows][::2] == list(evaluation.FORMS) and rows[0]["ratio"] == 1 and rows[4]["bytes"] == len(raw)
    for bad in (raw + b"x", raw[:-1], raw.replace(b"base_offset_v1", b"base_offset_v9")):
        with pytest.raises(blob.BlobError):
            evaluation.read_base_offset(bad)
    with pytest.raises(blob.BlobError):
        evaluation.base_offset_blob(sample(2, bid_sz_3=[None, 1.0]))


def days(spark, tables):
    parts = [t.append_column("symbol", pa.array([s] * t.num_rows)).append_column("trade_date", pa.array([d] * t.num_rows)) for s, d, t in tables]
    return spark.createDataFrame(pa.concat_tables(parts)).withColumn("trade_date", F.to_date("trade_date"))


def test_columns_agree_with_bytes(spark):
    books = days(spark, [("A", "2024-01-02", sample(9)), ("B", "2024-01-02", sample(3, bid_px_7=[None, 99.25, None]))])
    size = {r.symbol: r.blob_bytes for r in delta_columns.blob_size(books).collect()}
    assert size == {"A": len(blob.pack(sample(9))), "B": len(blob.pack(sample(3)))}
    trip = {r.symbol: r for r in blob.round_trip(books).collect()}
    assert all(trip[s].raw_bytes == size[s] and trip[s].differing_cells == 0 and trip[s].error is None for s in size)
    head = delta_columns.header(20, 1_000_000, F.lit(9))
    assert spark.range(1).select(head.alias("h")).first().h == blob.json.dumps(blob.header(9, 1_000_000), separators=(",", ":"))
    assert {r.symbol: r.differing_cells for r in delta_columns.verify(books, books).collect()} == {"A": 0, "B": 0}
    other = books.withColumn("ask_sz_2", F.when(F.col("symbol") == "A", F.lit(-0.0)).otherwise(F.col("ask_sz_2")).cast("float"))
    assert {r.symbol: r.differing_cells for r in delta_columns.verify(books, other).collect()} == {"A": 9, "B": 0}
    assert [(r.step, r["rank"]) for r in delta_columns.time_steps(books).where("symbol = 'A'").collect()] == [(100, 1)]


def test_a_bad_day_fails_alone(spark):
    books = days(spark, [("A", "2024-01-02", sample(2)), ("B", "2024-01-02", sample(2, bid_px_0=[100.0, None]))])
    assert {r.symbol: r.error for r in blob.round_trip(books).collect()} == {"A": None, "B": "row 1 has no best bid"}


def test_files_there_and_back(spark, tmp_path):
    books = days(spark, [("A", "2024-01-02", sample(9)), ("A", "2024-01-03", sample(5)), ("B", "2024-01-02", sample(3, bid_px_7=[None, 99.25, None]))])
    root, coded, back = (str(tmp_path / d) for d in ("books", "coded", "back"))
    assert sorted(r.rows for r in book_files.write_days(books, root).collect()) == [3, 5, 9]
    assert book_files.scan_books(spark, root).where("symbol = 'A' AND trade_date = '2024-01-03'").count() == 5
    done = book_files.encode_tree(spark, root, coded, level=3, verify=True).collect()
    assert {(r.status, r.rows) for r in done} == {("done", 9), ("done", 5), ("done", 3)} and all(r.output.endswith(".okxd.zst") for r in done)
    assert {r.status for r in book_files.encode_tree(spark, root, coded).collect()} == {"skipped"}
    assert {r.status for r in book_files.encode_tree(spark, root, str(tmp_path / "dry"), dry_run=True).collect()} == {"planned"} and not (tmp_path / "dry").exists()
    assert {r.status for r in book_files.decode_tree(spark, coded, back).collect()} == {"done"}
    assert {r.status for r in book_files.verify_tree(spark, back, coded).collect()} == {"done"}
    assert book_files.scan_blobs(spark, coded).count() == 17
    (tmp_path / "coded/A/2024-01-02.okxd.zst").write_bytes(b"junk")
    assert sorted(r.status for r in book_files.verify_tree(spark, back, coded).collect()) == ["done", "done", "failed"]
    assert not list(tmp_path.rglob("*.tmp"))


def test_distance_and_compression(spark):
    a = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 6.0)], "k int, x double, y double")
    b = spark.createDataFrame([(1, 1.0, 5.5), (2, 5.0, 6.0)], "k int, x double, y double")
    rows = delta_columns.worst(delta_columns.distance(a, b, ["k"], ["x", "y"]), 10).collect()
    assert [(r.column, r.max_abs, r.mean_abs, round(r.rmse, 6), r.nonzero) for r in rows] == [("x", 3.0, 1.5, 2.12132, 1), ("y", 0.5, 0.25, 0.353553, 1)]
    total = delta_columns.totals(delta_columns.distance(a, b, ["k"], ["x", "y"])).first()
    assert (total.columns, total.cells, total.nonzero, total.max_abs, total.mean_abs, round(total.rmse, 6)) == (2, 4, 2, 3.0, 0.875, round((9.25 / 4) ** 0.5, 6))
    sizes = spark.createDataFrame([("original", 100, 100), ("blob", 25, 100)], "name string, bytes long, original long")
    assert [(r.ratio, r.saved_pct) for r in delta_columns.compression(sizes).orderBy("bytes").collect()] == [(0.25, 75.0), (1.0, 0.0)]


def test_day_files_stream_in_row_groups(spark, tmp_path):
    n = 2_500
    books = days(spark, [("A", "2024-01-02", sample(n)), ("A", "2024-01-03", sample(7)), ("B C", "2024-01-02", sample(1))])
    done = book_files.write_sorted_days(books.coalesce(1).sortWithinPartitions("symbol", "trade_date", "timestamp_ms"), str(tmp_path), batch=1_000).collect()
    assert sorted(r.rows for r in done) == [1, 7, n]
    meta = book_files.pq.ParquetFile(str(tmp_path / "A/2024-01-02.parquet")).metadata
    assert meta.num_rows == n and all(meta.row_group(i).num_rows <= 1_000 for i in range(meta.num_row_groups))
    assert book_files.read_book(str(tmp_path / "A/2024-01-02.parquet")).equals(sample(n).cast(book_files.read_book(str(tmp_path / "A/2024-01-02.parquet")).schema))
    assert sorted((r.symbol, r["count"]) for r in book_files.scan_books(spark, str(tmp_path)).groupBy("symbol").count().collect()) == [("A", n + 7), ("B C", 1)]
    with pytest.raises(Exception, match="do not ascend"):
        book_files.write_sorted_days(books.coalesce(1).orderBy(F.desc("timestamp_ms")).coalesce(1).where("symbol = 'A' AND trade_date = '2024-01-02'"), str(tmp_path / "x")).collect()
    assert not list((tmp_path / "x").rglob("*.parquet"))


def test_running_sums_that_leave_64_bits_are_refused():
    raw = blob.pack(sample())
    start = 12 + int.from_bytes(raw[8:12], "little") + 80
    top = (2**63 - 1).to_bytes(8, "little")
    with pytest.raises(blob.BlobError, match="64 bits"):
        blob.unpack(raw[:start] + top + raw[start + 8 :])
    price = start + 8 + 12
    with pytest.raises(blob.BlobError, match="64 bits"):
        blob.unpack(raw[:price] + (-(2**63)).to_bytes(8, "little", signed=True) + bytes(12) + raw[price + 20 :])


def test_verify_tells_nan_bits_and_missing_rows(spark, tmp_path):
    quiet, other = (np.array([b, 0x3F800000], "<u4").view(np.float32) for b in (0x7FC00000, 0x7FC00001))
    for n, v in enumerate((quiet, other)):  # Arrow's writer keeps the bits; Spark's has one NaN
        book_files.publish(str(tmp_path / f"{n}/A/2024-01-02.parquet"), book_files.parquet_bytes(sample(2).set_column(2, "bid_sz_0", pa.array(v))))
    a, b = (book_files.scan_books(spark, str(tmp_path / f"{n}")) for n in (0, 1))
    assert delta_columns.verify(a, a).first().differing_cells == 0
    assert delta_columns.verify(a, b).first().differing_cells == 1
    c = days(spark, [("A", "2024-01-02", sample(3))])
    assert delta_columns.verify(days(spark, [("A", "2024-01-02", sample(2))]), c).first().differing_cells == 81
