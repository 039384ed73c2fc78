"""Replay and sampling: fixtures of known books, and random logs against a literal replay."""

import json
import random
from datetime import date, datetime, timezone

import pytest

from bookweave.functions import scalars
from bookweave.functions.strict_json import parse, parsed
from bookweave.operators import day_checks, fused, replay
from bookweave.plans import registry
from bookweave.streaming.online import online_books
from pyspark.sql import functions as F

SCHEMA = "symbol string, trade_date date, seq long, action string, ts string, bids array<array<string>>, asks array<array<string>>"
DAY = date(2024, 1, 2)


def records(spark, rows, symbol="X"):
    """rows: (action, ts, bids, asks)."""
    return spark.createDataFrame([(symbol, DAY, i, a, str(t), [[str(v) for v in l] for l in b], [[str(v) for v in l] for l in k]) for i, (a, t, b, k) in enumerate(rows)], SCHEMA)


def S(ts, bids=(), asks=()):
    return ("snapshot", ts, bids, asks)


def U(ts, bids=(), asks=()):
    return ("update", ts, bids, asks)


def literal(rows, depth, step=100):
    """One record after another, as an ordered map would hold them."""
    bids, asks, now, ready, grid, out = {}, {}, 0, False, None, []
    for action, ts, b, a in rows:
        if action not in ("snapshot", "update") or (action == "update" and not ready):
            continue
        text = str(ts)
        now = int(text) if text.lstrip("+-").isdigit() else now
        if action == "snapshot":
            bids, asks, ready = {}, {}, True
        for side, levels in ((bids, b), (asks, a)):
            for level in levels:
                try:
                    if str(level[0]) != str(level[0]).strip():
                        continue
                    px, q = float(level[0]), float(level[1])
                except (ValueError, IndexError):
                    continue
                if not (0 < px < float("inf")) or not (0 <= q < float("inf")):
                    continue
                key = int(px * 1e6 + 0.5)
                if q > 0:
                    side[key] = q
                elif action == "update":
                    side.pop(key, None)
        if grid is None:
            grid = (now // step + 1) * step
        while now >= grid:
            out.append((grid, [(k, bids[k]) for k in sorted(bids, reverse=True)[:depth]], [(k, asks[k]) for k in sorted(asks)[:depth]]))
            grid += step
    return out


def rows_of(df, depth):
    out = []
    for r in df.collect():
        side = lambda s: [(round(r[f"{s}_px_{i}"] * 1e6), r[f"{s}_sz_{i}"]) for i in range(depth) if r[f"{s}_px_{i}"] is not None]
        out.append((r.timestamp_ms, side("bid"), side("ask")))
    return sorted(out)


CASES = {
    "leading updates": ([U(1000, [(100, 1)]), U(1050, [(100, 2)]), S(1100, [(101, 4)], [(102, 5)]), U(1200, [(101, 6)])], [(1200, [(101, 6)], [(102, 5)])]),
    "look-ahead": ([S(1000, [(100, 1)]), U(1250, [(100, 9)])], [(1100, [(100, 9)], []), (1200, [(100, 9)], [])]),
    "aligned start": ([S(1000, [(100, 1)])], []),
    "tie": ([S(1000, [(100, 1)]), U(1100, [(100, 4)]), U(1100, [(100, 5)]), U(1200)], [(1100, [(100, 4)], []), (1200, [(100, 5)], [])]),
    "mid-day snapshot": ([S(1000, [(100, 1)]), S(1150, [(99, 2)])], [(1100, [(99, 2)], [])]),
    "bad time": ([S(1000), U("x", [(100, 7)]), U(1100)], [(1100, [(100, 7)], [])]),
    "unknown action": ([S(1000), ("other", 5000, [], []), U(1100)], [(1100, [], [])]),
    "zero in a snapshot": ([S(1000, [(100, 1), (100, 0)]), U(1100)], [(1100, [(100, 1)], [])]),
    "zero in an update": ([S(1000, [(99, 3)]), U(1100, [(100, 1), (100, 0)])], [(1100, [(99, 3)], [])]),
    "short level": ([S(1000, [(99, 3)]), U(1100, [(100,)])], [(1100, [(99, 3)], [])]),
    "bad price": ([S(1000, [("bad", 1), (100.5, 2)], [(101, 3)]), U(1100)], [(1100, [(100.5, 2)], [(101, 3)])]),
}


@pytest.mark.parametrize("engine", [replay, fused])
def test_cases(spark, engine):
    for name, (rows, want) in CASES.items():
        got = rows_of(engine.samples(records(spark, rows), depth=3), 3)
        assert got == [(t, [(round(p * 1e6), q) for p, q in b], [(round(p * 1e6), q) for p, q in a]) for t, b, a in want], name


def random_log(rng):
    rows, ts = [], 1000
    for _ in range(rng.randrange(5, 60)):
        ts += rng.choice([0, 0, 10, 40, 90, 100, 350])
        level = lambda: rng.choice([(rng.randrange(95, 105), rng.randrange(4)), (rng.choice(["bad", "-1", "0", "1e400", " 9"]), 1), (100, rng.choice(["x", "-1", "nan"])), (101,), (rng.randrange(95, 105) + 0.5, 2, "more")])
        rows.append((rng.choice(["update"] * 8 + ["snapshot", "other"]), ts if rng.random() < 0.9 else "soon", [level() for _ in range(rng.randrange(4))], [level() for _ in range(rng.randrange(4))]))
    return rows


def test_random_logs_against_a_literal_replay(spark):
    rng = random.Random(11)
    logs = [random_log(rng) for _ in range(40)]
    all_ = None
    for n, log in enumerate(logs):
        one = records(spark, log, f"s{n:02d}")
        all_ = one if all_ is None else all_.union(one)
    all_ = spark.createDataFrame(all_.collect(), SCHEMA)
    plan, ordered = (engine.samples(all_.repartition(3), depth=3).collect() for engine in (replay, fused))
    key = lambda r: (r.symbol, r.timestamp_ms)
    assert sorted(map(tuple, plan), key=str) == sorted(map(tuple, ordered), key=str)
    for n, log in enumerate(logs):
        want = literal(log, 3)
        got = sorted((r for r in plan if r.symbol == f"s{n:02d}"), key=key)
        assert [(r.timestamp_ms, [(round(r[f"bid_px_{i}"] * 1e6), r[f"bid_sz_{i}"]) for i in range(3) if r[f"bid_px_{i}"] is not None], [(round(r[f"ask_px_{i}"] * 1e6), r[f"ask_sz_{i}"]) for i in range(3) if r[f"ask_px_{i}"] is not None]) for r in got] == want


def test_depth_and_order(spark):
    rows = [S(1000, [(100 + i, 1) for i in range(25)], [(200 - i, 1) for i in range(25)]), U(1100)]
    got = rows_of(replay.samples(records(spark, rows)), 20)[0]
    assert [p / 1e6 for p, _ in got[1]] == [124 - i for i in range(20)] and [p / 1e6 for p, _ in got[2]] == [176 + i for i in range(20)]


def test_a_regression_fails_its_day_alone(spark):
    rows = records(spark, [S(1000), U(1100), U(1099), U(1300)], "bad").union(records(spark, [S(1000, [(1, 1)]), U(1100)], "good"))
    found = {r.symbol: r for r in replay.regressions(replay.keep(rows)).collect()}
    assert (found["bad"].failed, found["bad"].bad_ts, found["bad"].current_ts, found["good"].failed) == (True, 1099, 1100, False)
    assert {r.symbol for r in replay.samples(rows, depth=1).collect()} == {"good"}


@pytest.mark.parametrize("ids", [[1, 100_004, 200_007, 300_010, 2], [300_010, 200_007, 100_004, 2, 1], [200_007, 2, 1, 300_010, 100_004]])
def test_events_of_one_seq_follow_their_id_in_any_layout(spark, tmp_path, ids):
    seconds = {1: 10, 100_004: 20, 200_007: 15, 300_010: 12, 2: 30}  # all but the last have seq 7919
    rows = [(i, datetime(2024, 1, 2, 0, 0, seconds[i]), 1, "view", 1.5, '{"k": 3}') for i in ids]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = [tuple(r) for r in registry.QUERIES["lob_ts_regressions"](spark, str(tmp_path)).collect()]
    start = datetime(2024, 1, 2, tzinfo=timezone.utc).timestamp() * 1000
    assert got == [("view", "2024-01-02", True, 7919.0, start + 15_000, start + 20_000)]


def test_online_replay_gives_the_same_books(spark, tmp_path):
    rng = random.Random(5)
    log = sorted((r for r in random_log(rng) + random_log(rng)), key=lambda r: r[1] if isinstance(r[1], int) else 0)
    rows = records(spark, [S(900, [(100, 1)], [(101, 1)]), *(r for r in log if isinstance(r[1], int))])
    for n, part in enumerate((rows.where("seq < 20"), rows.where("seq >= 20"))):
        part.coalesce(1).write.json(str(tmp_path / "in"), mode="append") if n else part.coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = online_books(stream, depth=2).writeStream.format("memory").queryName("books").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.table("books").collect()), key=str)
    want = replay.sampled_books(rows, depth=2)
    assert got == sorted(map(tuple, want.select(spark.table("books").columns).collect()), key=str) and got


GOOD = '{"action":"update","ts":"1","bids":[["1","2","x"]],"asks":[]}'
LINES = [
    (GOOD, True), ('{"action":"a","ts":"1"}', True), ('["update","1"]', True), ('["update","1",[["1","2"]],[]]', True), ('{"action":"a","ts":"1","more":[null,1.5e3]}', True), (f"  {GOOD} ", True),
    ("not-json", False), (" ", False), ('{"action":"a","ts":1}', False), ('{"action":"a","ts":"1","bids":null}', False), ('{"action":"a","ts":"1","bids":[[1,2]]}', False), ('{"ts":"1"}', False),
    ('{"action":"a","action":"b","ts":"1"}', False), (GOOD + "x", False), ('{"action":"a","ts":"1","x":NaN}', False), ('["update"]', False), ('["a","1",[],[],1]', False), ('{"action":"\\ud800","ts":"1"}', False),
]


def test_strict_lines(spark):
    assert [parse(x) is not None for x, _ in LINES] == [ok for _, ok in LINES]
    rows = parsed(spark.createDataFrame([(i, x) for i, (x, _) in enumerate([*LINES, ("", False)])], "seq long, line string")).orderBy("seq").collect()
    assert [r.ok for r in rows] == [ok for _, ok in LINES] and rows[0].bids == [["1", "2", "x"]] and rows[1].asks == []


def test_plain_lines_are_read_as_the_parser_reads_them(spark):
    levels = ["[]", '[["1","2"]]', '[["1","2","0","3"],[]]', '[["","\u00e9"]]', '[["1" ,"2"]]', '[["1",2]]', "[[]", '[["a\\"b","2"]]', '["1"]', "null"]
    heads = ["", '"instId":"A-B",', '"instId":"A","instId":"B",', '"other":1,', '"action":"x",']
    tails = ["", " ", "x", ',"ts":"2"']
    lines = [f'{{{h}"action":"update","ts":"7","{a}":{x},"{b}":{y}}}{t}' for h in heads for a, b in (("bids", "asks"), ("asks", "bids"), ("bids", "bids")) for x in levels for y in levels[:4] for t in tails]
    lines += [f'{{"ts":"7","action":"a","bids":{x}}}' for x in levels] + ['{"action":"update","ts":"7","asks":[],"bids":[]}\n', '{"action":"\t","ts":"7","asks":[],"bids":[]}']
    many = ",".join(f'["{i}","1"]' for i in range(50_000))
    lines.append(f'{{"action":"snapshot","ts":"1","bids":[{many}],"asks":[]}}')
    rows = parsed(spark.createDataFrame(list(enumerate(lines)), "seq long, line string")).orderBy("seq").collect()
    none = dict.fromkeys(("action", "ts", "bids", "asks"))
    want = [(i, r is not None, *({**none, **(r or {})}).values()) for i, r in enumerate(map(parse, lines))]
    assert list(map(tuple, rows)) == want and sum(r.ok for r in rows) > 50


def test_bad_line_share(spark):
    def day(symbol, total, bad, snapshot=True):
        return [(symbol, DAY, i, i >= bad, "snapshot" if snapshot and i == total - 1 else "update") for i in range(total)]

    rows = spark.createDataFrame(day("edge", 1000, 1) + day("over", 999, 1) + day("none", 5, 0, False), "symbol string, trade_date date, seq long, ok boolean, action string")
    assert {r.symbol: (r.failed, r.no_snapshot) for r in day_checks.bad_lines(rows).collect()} == {"edge": (False, False), "over": (True, False), "none": (True, True)}


PRICES = [("100.5", 100_500_000), ("0.0000004", 0), ("0.0000005", 1), ("1e2", 100_000_000), ("+.5", 500_000), ("5.", 5_000_000), ("0", None), ("-1", None), ("inf", None), ("nan", None), ("1e400", None), (" 1", None), ("1.5d", None), ("0x1p3", None), ("1e30", 2**63 - 1), ("", None), (None, None)]
SIZES = [("1", 1.0), ("0", 0.0), ("-0", 0.0), ("1e-50", 0.0), ("1e39", None), ("-1", None), ("x", None), ("0.1", 0.10000000149011612)]


def test_scalars(spark):
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PRICES)], "i int, p string").select("i", scalars.price_key(F.col("p")).alias("k")).orderBy("i").collect()
    assert [r.k for r in rows] == [k for _, k in PRICES]
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(SIZES)], "i int, p string").select("i", scalars.quantity(F.col("p")).alias("k")).orderBy("i").collect()
    assert [r.k for r in rows] == [k for _, k in SIZES]
    rows = spark.createDataFrame([("a,b",), ('say "x"',), ("plain",), ("l\nm",)], "t string").select(scalars.csv_field(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == ['"a,b"', '"say ""x"""', "plain", '"l\nm"']


def test_schema_check(spark):
    good = spark.createDataFrame([], day_checks.book_schema())
    assert day_checks.schema_errors(good) == [] and len(day_checks.schema_errors(good.select("timestamp_ms"))) == 80
    assert "is double" in day_checks.schema_errors(good.withColumn("bid_px_0", F.lit(1.0)))[0]
    with pytest.raises(ValueError, match="the table lacks"):
        day_checks.require_book(good.drop("ask_sz_19"))


def test_json_round_trip_of_records(spark):
    line = json.dumps({"action": "snapshot", "ts": "5", "bids": [["1", "2"]], "asks": []})
    assert parse(line)["bids"] == [["1", "2"]]
