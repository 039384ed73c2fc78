"""Archives, tasks, ledger, the daily run and the command line."""

import gzip
import io
import json
import os
import subprocess
import sys
import threading
import zlib
from datetime import date
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from bookweave import cli, session
from bookweave.operators import ledger, tasks
from bookweave.plans import daily
from bookweave.sources import archive, archive_writer, book_files, ledger_files

D = date(2024, 1, 2)
SNAP, UPD = ({"action": "snapshot", "ts": "1000", "bids": [["100", "1"]], "asks": [["101", "2"]]}, {"action": "update", "ts": "1100", "bids": [["100", "3"]], "asks": []})


def lines(*rows):
    return "".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows).encode()


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_archives(spark, tmp_path):
    whole = archive_writer.archive([("d", None), ("a.json", lines(SNAP, "", "bad")), ("empty", b""), ("b.json", json.dumps(UPD).encode() + b"\r\n\xff\xfe\n")])
    cases = {"whole": whole, "cut": whole[:-8], "text": gzip.compress(b"no tar " * 100), "empty": b"", "bare": gzip.compress(b"\0" * 1024)}
    for name, data in cases.items():
        put(tmp_path / name / "2024-01-02.tar.gz", data)
    rows = archive.read_archives(spark, str(tmp_path)).orderBy("symbol", "seq").collect()
    assert [(r.entry, r.seq, r.line) for r in rows if r.symbol == "whole"] == [(0, 1, json.dumps(SNAP)), (0, 3, "bad"), (1, 4, json.dumps(UPD))]
    assert {r.symbol for r in rows if r.error} == {"cut", "text", "empty", "bare"}
    assert {n: archive.valid(str(tmp_path / n / "2024-01-02.tar.gz")) is None for n in cases} == {"whole": True, "cut": False, "text": False, "empty": False, "bare": False}


def test_targets(spark):
    text = ["\tBTC-USDT-SWAP\t:\u00a02024-07-01", "\t \u3000", " \t # already handled", " A : 2024-01-02 ", "BTC,2024-01-01", ":2024-01-01", "A:", "A:2024-99-99", "A:2024-01-02"]
    rows = tasks.targets(spark.createDataFrame(list(enumerate(text, 1)), "line_no long, line string")).orderBy("line_no").collect()
    assert [(r.line_no, r.error or (r.symbol, str(r.trade_date))) for r in rows] == [(1, ("BTC-USDT-SWAP", "2024-07-01")), (4, ("A", "2024-01-02")), (5, "no colon between instrument and day"), (6, "no instrument"), (7, "no day"), (8, "2024-99-99 is no day"), (9, ("A", "2024-01-02"))]
    frame = lambda x: spark.createDataFrame([(i, t) for i, t in x], "line_no long, line string")
    with pytest.raises(ValueError, match="line 5: no colon"):
        tasks.load_targets(frame(enumerate(text, 1)))
    with pytest.raises(ValueError, match="no targets"):
        tasks.load_targets(frame([(1, "#")]))
    assert len(tasks.load_targets(frame([(1, text[0]), (4, text[3]), (9, text[8])])).collect()) == 2


def test_ranges_urls_and_small_rules(spark):
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    day = lambda s: F.lit(s).cast("date")
    assert tasks.date_range(symbols, day("2024-02-28"), day("2024-03-01")).count() == 6
    assert tasks.date_range(symbols, day("2024-03-01"), day("2024-02-28")).count() == 0
    assert [str(r.trade_date) for r in tasks.lookback(symbols.limit(1), day("2024-03-01"), 2).collect()] == ["2024-02-29", "2024-02-28"]
    one = spark.range(1).select(tasks.archive_url(F.lit("BTC-USDT"), day("2024-01-02")).alias("u"), *(tasks.backoff_seconds(F.lit(n)).alias(f"b{n}") for n in (0, 1, 5, 6, 70)), tasks.not_available(day("2024-01-02"), day("2024-01-02")).alias("n")).first()
    assert one.u.endswith("/20240102/BTC-USDT-L2orderbook-400lv-2024-01-02.tar.gz") and list(one)[1:] == [0, 1, 16, 30, 30, "not_available"]
    with pytest.raises(ValueError):
        tasks.check_bounds(date(2024, 1, 2), date(2024, 1, 1))
    files = spark.createDataFrame([("a.tar.gz", 5), ("b.tmp", 2), ("c.parquet", 9)], "path string, length long")
    assert tuple(tasks.raw_usage(files).first()) == (2, 7)


def test_fold_against_single_steps(spark):
    kinds = ["download_success", "process_failure", "download_failure", "download_success", "process_success", "not_available", "process_failure"]
    events = [("A", D, i, k, f"why {i}", 10 + i) for i, k in enumerate(kinds)]
    frame = lambda x: spark.createDataFrame(x, "symbol string, trade_date date, seq long, kind string, reason string, rows long")
    todo = frame(events).select("symbol", "trade_date").distinct()
    state = spark.createDataFrame([("A", D, "pending", "pending", 0, 0)], "symbol string, trade_date date, download string, process string, download_attempts int, process_attempts int")
    for n in range(len(kinds)):
        state = daily.transition(state, frame(events[n : n + 1]))
        want = ledger.fold(frame(events[: n + 1])).select(state.columns)
        assert state.collect() == want.collect(), kinds[n]
    assert todo.count() == 1


def test_ledger_files(spark, tmp_path):
    root = str(tmp_path)
    put(tmp_path / "OLD.json", json.dumps({"2024-01-02": {"downloaded": True, "validated": True, "rows": 42, "raw_deleted": True}, "2024-01-03": {"download_attempts": 2}}).encode())
    put(tmp_path / "BAD/2024-01-02.json", b"{not json")
    put(tmp_path / "NEW/2024-01-02.json", json.dumps({"download": "success", "process": "success", "raw_deleted": True, "rows": 7}).encode())
    todo = spark.createDataFrame([("OLD", D), ("OLD", date(2024, 1, 3)), ("BAD", D), ("NEW", D), ("NONE", D)], "symbol string, trade_date date")
    got = {(r.symbol, str(r.trade_date)): r for r in ledger_files.read_states(spark, root, todo).collect()}
    assert {k: (r.task_status, r.rows) for k, r in got.items()} == {("OLD", "2024-01-02"): ("success", 42), ("OLD", "2024-01-03"): ("failed", None), ("BAD", "2024-01-02"): ("pending", None), ("NEW", "2024-01-02"): ("success", 7), ("NONE", "2024-01-02"): ("pending", None)}
    new = got["NEW", "2024-01-02"]
    assert new.downloaded and new.processed and new.parquet_present and not new.raw_present
    assert ledger_files.write_states(ledger_files.read_states(spark, root, todo), root) == 5
    again = json.loads((tmp_path / "OLD/2024-01-02.json").read_text())
    assert again["rows"] == 42 and again["task_status"] == "success" and again["updated_at"] and again["last_error"] is None


def test_routing(spark):
    days = [date(2024, 1, n) for n in range(1, 6)]
    todo = spark.createDataFrame([("A", d) for d in days], "symbol string, trade_date date")
    states = spark.createDataFrame([("A", days[0], "success"), ("A", days[1], "not_available"), ("A", days[4], "success")], "symbol string, trade_date date, task_status string")
    files = spark.createDataFrame([("A", days[0], True, True), ("A", days[2], True, False)], "symbol string, trade_date date, raw boolean, parquet boolean")
    assert [r.queue for r in ledger.route(todo, states, files).orderBy("trade_date").collect()] == ["done", "skip", "process", "download", "download"]


def config(tmp_path, **more):
    return daily.Config(*(str(tmp_path / d) for d in ("raw", "parquet", "ledger")), tries=0, retry_delay_s=0, cutoff=date(2024, 1, 5), **more)


def local_fetch(archives):
    def fetch(symbol, day, path):
        data = archives.get((symbol, day.day))
        if data is None:
            return False
        if data == b"down":
            raise OSError("network, unreachable")
        book_files.publish(path, data)
        return True

    return fetch


def test_fetching_over_http(tmp_path):
    good = archive_writer.archive([("a.json", lines(SNAP))])
    put(tmp_path / "www/20240101/A-L2orderbook-400lv-2024-01-01.tar.gz", good)
    put(tmp_path / "www/20240102/A-L2orderbook-400lv-2024-01-02.tar.gz", good[:-8])
    handler = partial(SimpleHTTPRequestHandler, directory=str(tmp_path / "www"))
    with ThreadingHTTPServer(("127.0.0.1", 0), handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        base, path = f"http://127.0.0.1:{server.server_port}", str(tmp_path / "raw/A/x.tar.gz")
        assert daily.fetch_http("A", date(2024, 1, 1), path, base) and (tmp_path / "raw/A/x.tar.gz").read_bytes() == good
        assert daily.fetch_http("A", date(2024, 1, 3), path, base) is False
        with pytest.raises(OSError):
            daily.fetch_http("A", date(2024, 1, 2), path, base)
        server.shutdown()
    assert not (tmp_path / "raw/A/x.tar.gz").exists()
    with pytest.raises(OSError, match="got 3 of 4"):
        book_files.publish(path, io.BytesIO(b"abc"), 4)
    assert list((tmp_path / "raw/A").iterdir()) == []


def test_daily_run(spark, tmp_path):
    good = archive_writer.archive([("a.json", lines(SNAP)), ("b.json", lines(UPD, {**UPD, "ts": "1350"}))])
    late = archive_writer.archive([("a.json", lines(SNAP, UPD, {**UPD, "ts": "1099"}))])
    bad = archive_writer.archive([("a.json", lines(SNAP, "not-json", UPD))])
    short = archive_writer.archive([("a.json", lines(SNAP))])
    updates = archive_writer.archive([("a.json", lines(UPD))])
    archives = {("A", 1): good, ("A", 2): late, ("A", 3): bad, ("A", 4): short, ("B", 1): b"down", ("B", 2): updates, ("B", 3): good[:-8]}
    todo = [("A", date(2024, 1, n)) for n in range(1, 6)] + [("B", date(2024, 1, n)) for n in (1, 2, 3, 9)] + [("A", date(2024, 1, 1))]
    c = config(tmp_path, retries=1, wave=4)
    slept = []
    report = daily.run(spark, todo, c, local_fetch(archives), sleep=slept.append)
    assert report == {"success": 1, "not_available": 1, "failed": 7} and slept
    book = book_files.read_book(str(tmp_path / "parquet/A/2024-01-01.parquet"))
    assert book["timestamp_ms"].to_pylist() == [1100, 1200, 1300] and book["bid_sz_0"].to_pylist() == [3.0] * 3
    daily.write_summary(spark, todo[:9], c, str(tmp_path / "s.csv"))
    rows = (tmp_path / "s.csv").read_text().splitlines()
    assert rows[:2] == ["inst,tradedate,status,rows,error", "A,2024-01-01,success,3,"] and "1099" in rows[2] and "1 of 3" in rows[3] and rows[4].endswith("the day gives no samples") and rows[5] == "A,2024-01-05,not_available,,"
    assert rows[6] == 'B,2024-01-01,failed,,"network, unreachable"' and rows[7].endswith("the day has no snapshot") and "not published yet" in rows[9]
    assert not list((tmp_path / "raw").rglob("*.tar.gz")) and [p.name for p in (tmp_path / "parquet").rglob("*.parquet")] == ["2024-01-01.parquet"]
    state = json.loads((tmp_path / "ledger/A/2024-01-02.json").read_text())
    assert (state["download_attempts"], state["process_attempts"], state["task_status"]) == (2, 2, "failed")
    calls = []
    assert daily.run(spark, todo[:1] + todo[4:5], c, lambda *a: calls.append(a)) == {"success": 1, "not_available": 1, "failed": 0} and not calls


def test_raw_files_that_are_there_are_not_fetched(spark, tmp_path):
    put(tmp_path / "raw/A/2024-01-01.tar.gz", archive_writer.archive([("a.json", lines(SNAP, UPD))]))
    put(tmp_path / "raw/A/old.tmp", b"x")
    c = config(tmp_path)
    assert daily.run(spark, [("A", date(2024, 1, 1))], c, local_fetch({}))["success"] == 1
    assert not list((tmp_path / "raw").rglob("*.tmp")) and daily.run(spark, [], c) == {"success": 0, "not_available": 0, "failed": 0}


def test_command_line(spark, tmp_path, capsys):
    put(tmp_path / "raw/A/2024-01-01.tar.gz", archive_writer.archive([("a.json", lines(SNAP, UPD))]))
    (tmp_path / "t.txt").write_text("A:2024-01-01\n# done\n")
    roots = [f"--{d}-root={tmp_path / d}" for d in ("raw", "parquet", "ledger")]
    assert cli.main(["run", "--target-file", str(tmp_path / "t.txt"), *roots, "--summary-csv", str(tmp_path / "s.csv")]) == 0
    book, coded, back = str(tmp_path / "parquet/A/2024-01-01.parquet"), str(tmp_path / "x.okxd.zst"), str(tmp_path / "y.parquet")
    for args in (["encode", book, "-o", coded], ["inspect", coded], ["verify", book, coded], ["decode", coded, "-o", back]):
        assert cli.main(["delta", *args]) == 0
    assert "rows=1 depth=20 scale=1000000" in capsys.readouterr().out and book_files.read_book(back).num_rows == 1
    assert cli.main(["delta", "inspect", back]) == 1
    assert cli.main(["delta", "evaluate", book]) == 1  # a one-sided depth has nulls
    assert cli.main(["transfer", "encode", str(tmp_path / "parquet"), str(tmp_path / "t"), "--verify"]) == 0 and (tmp_path / "t/A/2024-01-01.okxd.zst").exists()
    assert cli.main(["transfer", "decode", str(tmp_path / "t"), str(tmp_path / "u")]) == 0 and (tmp_path / "u/A/2024-01-01.parquet").exists()
    assert cli.main(["run", "--symbol", "A", "--start", "2024-01-02", "--end", "2024-01-01", *roots]) == 1
    with pytest.raises(SystemExit):
        cli.main(["run", "--symbol", "A", "--target-file", "x"])


def test_crc_of_writer_is_stable():
    assert zlib.crc32(archive_writer.archive([("a", b"x")])) == zlib.crc32(archive_writer.archive([("a", b"x")]))


def test_two_writers_of_one_day_lose_no_update(spark, tmp_path):
    c = config(tmp_path)
    runs = [threading.Thread(target=daily._record, args=(spark, c, [("A B", D, "download_failure", "x", None)])) for _ in range(3)]
    for t in runs:
        t.start()
    for t in runs:
        t.join()
    state = json.loads((tmp_path / f"ledger/A B/{D}.json").read_text())
    assert state["download_attempts"] == 3 and not (tmp_path / "ledger/.lock").exists()
    (tmp_path / "ledger/.lock").touch()
    with pytest.raises(TimeoutError), ledger_files.locked(spark, c.ledger_root, wait_s=0.2):
        pass
    with ledger_files.locked(spark, c.ledger_root, wait_s=0.2, stale_s=-1):
        pass


def test_the_cap_on_raw_files_holds_while_fetching(spark, tmp_path):
    data = archive_writer.archive([("a.json", lines(SNAP, UPD))])
    days = [date(2024, 1, n) for n in range(1, 6)]

    def fetch(symbol, day, path):
        book_files.publish(path, data)
        (tmp_path / f"seen-{day}-{archive.usage(str(tmp_path / 'raw'))}").touch()
        return True

    c = config(tmp_path, concurrency=1, raw_max_bytes=2 * len(data))
    assert daily.run(spark, [("A", d) for d in days], c, fetch) == {"success": 5, "not_available": 0, "failed": 0}
    most = [int(p.name.rsplit("-", 1)[1]) for p in tmp_path.glob("seen-*")]
    assert len(most) == 5 and max(most) <= 2 * len(data)
    put(tmp_path / "raw/other.tar.gz", data * 3)
    with pytest.raises(ValueError, match="fill the cap"):
        daily.run(spark, [("B", D)], c, fetch)


def test_daily_round(spark, tmp_path):
    good = archive_writer.archive([("a.json", lines(SNAP, UPD))])
    archives = {("A", 4): good, ("A", 3): good, ("B", 4): good}
    roots = [f"--{d}-root={tmp_path / d}" for d in ("raw", "parquet", "ledger", "transfer")]
    copies = [f"--copy-{d}={tmp_path / 'far' / d}" for d in ("books", "blobs", "logs")]
    args = ["daily", "--symbol", "A", "--symbol", "B", "--run-date", "2024-01-05", "--lookback-days", "2", "--zstd-level", "3", "--verify", "--clean", "--summary-csv", str(tmp_path / "logs/s.csv"), "--retry-delay-secs", "0"]
    assert cli.main([*args, *roots, *copies], fetch=local_fetch(archives)) == 0
    far = sorted(str(p.relative_to(tmp_path / "far")) for p in (tmp_path / "far").rglob("*") if p.is_file())
    assert far == ["blobs/A/2024-01-03.okxd.zst", "blobs/A/2024-01-04.okxd.zst", "blobs/B/2024-01-04.okxd.zst", "books/A/2024-01-03.parquet", "books/A/2024-01-04.parquet", "books/B/2024-01-04.parquet", "logs/s.csv"]
    assert (tmp_path / "logs/s.csv").read_text().splitlines()[1:] == ["A,2024-01-04,success,1,", "B,2024-01-04,success,1,", "A,2024-01-03,success,1,", "B,2024-01-03,not_available,,"]
    assert not [p for d in ("raw", "parquet", "transfer") for p in (tmp_path / d).rglob("*") if p.is_file()]
    archives["C", 4] = b"down"
    assert cli.main([*args[:2], "C", *args[5:], *roots, "--dl-retries", "0"], fetch=local_fetch(archives)) == 1


def test_shared_folders_are_empty_after_clean(spark):
    before = session.parts(spark)
    kept = session.settle(spark.range(5))
    gone = session.settle(spark.range(6))
    session.release(gone)
    other = session.settle(spark.range(7))
    session.clean(spark, before, keep=kept)
    assert session.parts(spark) == [*before, kept._settled] and kept.count() == 5
    session.clean(spark, before)
    assert session.parts(spark) == before
    assert not any(os.path.exists(df._settled) for df in (kept, gone, other))


def test_the_package_as_one_file(tmp_path):
    (tmp_path / "b.zip").write_bytes(session.archive())
    out = subprocess.run([sys.executable, "-c", "import bookweave.operators.fused as m; print(m.__file__)"], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path / "b.zip")}, capture_output=True, text=True, check=True).stdout
    assert "b.zip" in out and session.archive() == session.archive()
