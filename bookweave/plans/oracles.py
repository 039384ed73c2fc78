"""DuckDB SQL for the registered queries."""

from __future__ import annotations

DEPTH, MINUTE, FIVE = 20, 60_000, 300_000


def base(first_snapshot: bool = True, shuffled: bool = False) -> str:
    seq = "event_id * 7919 % 100003" if shuffled else "event_id"
    first = f" OR row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY {seq}) = 1" if first_snapshot else ""
    return f"""WITH base AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS trade_date, {seq} AS seq, event_id, epoch_us(ts) // 1000 AS ms,
    CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, CAST(round(value * 1000000) AS BIGINT) AS px_key, value > 0 AS ok,
    CAST(CAST(json_extract_string(props, '$.k') AS FLOAT) AS DOUBLE) AS qty,
    CASE WHEN event_id % 40 = 0{first} THEN 'snapshot' ELSE 'update' END AS action
  FROM events),
epochs AS (SELECT *, CAST(sum(CASE WHEN action = 'snapshot' THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, trade_date ORDER BY seq) AS BIGINT) AS epoch FROM base)"""


def kept(bad_ts: bool = False, **options) -> str:
    ms = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE ms END" if bad_ts else "ms"
    return base(**options) + f""",
carried AS (SELECT *, coalesce(last_value({ms} IGNORE NULLS) OVER (PARTITION BY symbol, trade_date ORDER BY seq ROWS UNBOUNDED PRECEDING), 0) AS ets FROM epochs WHERE epoch > 0),
kept AS (SELECT *, lag(ets) OVER (PARTITION BY symbol, trade_date ORDER BY seq) AS pts FROM carried)"""


def intervals() -> str:
    return kept() + """,
levels AS (SELECT * FROM kept WHERE ok AND qty >= 0 AND (action = 'update' OR qty > 0)),
spans AS (SELECT *, lead(seq) OVER (PARTITION BY symbol, trade_date, epoch, side, px_key ORDER BY seq) AS next_seq FROM levels),
live AS (SELECT * FROM spans WHERE qty > 0)"""


def triggers(width: int) -> str:
    return f""",
trig AS (SELECT symbol, trade_date, epoch, seq, pts // {width} + 1 AS first_grid, ets // {width} AS last_grid FROM kept WHERE pts IS NOT NULL AND ets // {width} > pts // {width})"""


def top(width: int, depth: int = DEPTH) -> str:
    return intervals() + triggers(width) + f""",
ranked AS (
  SELECT t.symbol, t.trade_date, t.seq, l.side, l.px_key, l.qty,
    row_number() OVER (PARTITION BY t.symbol, t.trade_date, t.seq, l.side ORDER BY CASE WHEN l.side = 'bid' THEN -l.px_key ELSE l.px_key END) - 1 AS level
  FROM trig t JOIN live l ON t.symbol = l.symbol AND t.trade_date = l.trade_date AND t.epoch = l.epoch AND l.seq <= t.seq AND (l.next_seq IS NULL OR t.seq < l.next_seq)),
top AS (SELECT *, CAST(CAST(px_key / 1000000.0::DOUBLE AS FLOAT) AS DOUBLE) AS px FROM ranked WHERE level < {depth})"""


def columns(depth: int = DEPTH) -> list[str]:
    return [f"{s}_{k}_{i}" for s in ("bid", "ask") for i in range(depth) for k in ("px", "sz")]


def wide(width: int, depth: int = DEPTH) -> str:
    cells = ", ".join(f"max(CASE WHEN side = '{s}' AND level = {i} THEN {'px' if k == 'px' else 'qty'} END) AS {s}_{k}_{i}" for s in ("bid", "ask") for i in range(depth) for k in ("px", "sz"))
    return top(width, depth) + f""",
cells AS (SELECT symbol, trade_date, seq, {cells} FROM top GROUP BY ALL),
books AS (SELECT t.symbol, t.trade_date, t.seq, first_grid, last_grid, {', '.join(columns(depth))} FROM trig t LEFT JOIN cells c USING (symbol, trade_date, seq))"""


def samples(width: int, depth: int = DEPTH) -> str:
    return wide(width, depth) + f""",
samples AS (SELECT symbol, trade_date, unnest(range(first_grid, last_grid + 1)) * {width} AS timestamp_ms, {', '.join(columns(depth))} FROM books)"""


def coded() -> str:
    """Triggers with both best prices; long cells with whole prices."""
    return top(FIVE) + f""",
both_sides AS (SELECT symbol, trade_date, seq FROM top WHERE level = 0 GROUP BY ALL HAVING count(*) = 2),
codable AS (SELECT symbol, trade_date, seq, last_grid * {FIVE} AS timestamp_ms FROM trig JOIN both_sides USING (symbol, trade_date, seq)),
cell AS (
  SELECT c.symbol, c.trade_date, c.timestamp_ms, side, level, qty, px, CAST(round(px * 1000000) AS BIGINT) AS whole,
    first_value(CAST(round(px * 1000000) AS BIGINT)) OVER (PARTITION BY c.symbol, c.trade_date, c.seq, side ORDER BY level) AS base
  FROM codable c JOIN top USING (symbol, trade_date, seq))"""


ORDERS = """WITH o AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS trade_date, o_orderkey AS seq, o_custkey AS n_rows, o_orderstatus, o_totalprice,
    ['download_success', 'download_failure', 'not_available', 'process_success', 'process_failure'][1 + o_orderkey % 5] AS kind,
    'status ' || o_orderstatus || ', retry "exhausted"' AS reason
  FROM orders)"""


def folded(where: str = "true", orders: str = "") -> str:
    return (orders or ORDERS) + f""",
k AS (SELECT *, CASE kind WHEN 'download_success' THEN 'success' WHEN 'download_failure' THEN 'failed' WHEN 'not_available' THEN 'not_available' END AS down,
  CASE kind WHEN 'process_success' THEN 'success' WHEN 'process_failure' THEN 'failed' END AS done FROM o WHERE {where}),
g AS (SELECT symbol, trade_date, coalesce(arg_max(down, seq) FILTER (down IS NOT NULL), 'pending') AS download, coalesce(arg_max(done, seq) FILTER (done IS NOT NULL), 'pending') AS process,
  CAST(count(down) AS INTEGER) AS download_attempts, CAST(count(done) AS INTEGER) AS process_attempts, max(seq) AS last_seq FROM k GROUP BY ALL),
f AS (SELECT g.*, CASE WHEN kind = 'process_success' THEN n_rows END AS rows, kind <> 'download_success' AS raw_deleted,
  CASE WHEN kind IN ('download_failure', 'process_failure') THEN reason END AS last_error FROM g JOIN k ON k.symbol = g.symbol AND k.trade_date = g.trade_date AND k.seq = g.last_seq),
states AS (SELECT *, {DERIVED} FROM f)"""


MONTHLY = ORDERS.replace("CAST(o_orderdate AS DATE) AS trade_date", "CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS trade_date")
FIRST = MONTHLY.replace("WITH o AS (", "WITH every AS (") + ", o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date ORDER BY seq) AS place FROM every) WHERE place <= 3)"

DERIVED = """download = 'success' AS downloaded, download = 'not_available' AS not_available, process = 'success' AS processed, process = 'success' AS validated,
  download = 'success' AND NOT raw_deleted AS raw_present, process = 'success' AS parquet_present,
  CASE WHEN download = 'not_available' THEN 'not_available' WHEN process = 'success' THEN 'success' WHEN download = 'failed' OR process = 'failed' THEN 'failed' ELSE 'pending' END AS task_status"""

STATE = "download, process, download_attempts, process_attempts, rows, raw_deleted, last_error, downloaded, not_available, processed, validated, raw_present, parquet_present, task_status"
BAD = "event_id % 997 = 0"
DAY = "symbol, trade_date"
ALL = ", ".join(columns())
HEADER_LETTERS = len('{"format":"base_offset_v1","rows":,"depth":20,"scale":1000000,"timestamp":"timestamp_ms","bid_px_cols":[],"ask_px_cols":[],"size_cols":[],"sizes":"raw_f32","null_bitmap":"one_bitmap_per_f32_column"}') + sum(len(f'"{c}",') for c in columns()) - 3
SIZED = f"""sized AS (SELECT symbol, trade_date, count(*) AS rows, {HEADER_LETTERS} + len(CAST(count(*) AS VARCHAR)) AS header_bytes FROM codable GROUP BY ALL),
blob AS (SELECT *, 12 + header_bytes + 80 * ((rows + 7) // 8) + 8 + 4 * (rows - 1) + 2 * (8 + 4 * (rows - 1) + 80 * rows) + 160 * rows AS blob_bytes FROM sized)"""


#: Letters of the experiments' headers, but for the digits of the row count.
STEPS_HEAD = len('{"format":"column_time_delta_v1","rows":,"scale":1000000,"timestamp":"timestamp_ms","price_cols":[],"size_cols":[],"sizes":"raw_f32"}') + sum(len(f'"{c}",') for c in columns()) - 2
OFFSETS_HEAD = len('{"format":"base_offset_v1","rows":,"depth":20,"scale":1000000,"timestamp":"timestamp_ms","bid_px_cols":[],"ask_px_cols":[],"size_cols":[],"sizes":"raw_f32","bid_offsets":"bid_px_0_minus_bid_px_i_i32","ask_offsets":"ask_px_i_minus_ask_px_0_i32"}') + sum(len(f'"{c}",') for c in columns()) - 3


def bit(column: str, m: int) -> str:
    return f"CASE WHEN {column} % {m} < {m - 1} THEN {column} % {m} = 0 END"


def targets() -> str:
    return ORDERS + """,
l AS (SELECT seq AS line_no, symbol, strftime(trade_date, '%Y-%m-%d') AS d, seq % 7 AS n, trade_date FROM o)
SELECT line_no, CASE WHEN n = 6 THEN symbol END AS symbol, CASE WHEN n = 6 THEN trade_date END AS trade_date,
  CASE n WHEN 2 THEN 'no colon between instrument and day' WHEN 3 THEN 'no instrument' WHEN 4 THEN '2024-99-99 is no day' WHEN 5 THEN 'no day' END AS error
FROM l WHERE n > 1"""


QUOTED = lambda c: f"""CASE WHEN {c} LIKE '%,%' OR {c} LIKE '%"%' THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END"""

ERROR = "coalesce(last_error, '')"

ORACLES: dict[str, str] = {
    "lob_parse_levels": base() + " SELECT seq, side, 0 AS pos, px_key, qty FROM base WHERE ok AND qty >= 0",
    "lob_price_keys": "SELECT px_key, count(*) AS n, CAST(CAST(px_key / 1000000.0::DOUBLE AS FLOAT) AS DOUBLE) AS price FROM (SELECT CAST(round(value * 1000000) AS BIGINT) AS px_key FROM events WHERE value > 0) GROUP BY px_key",
    "lob_json_records": base() + f" SELECT seq, NOT {BAD} AS ok, CASE WHEN NOT {BAD} THEN action END AS action, CASE WHEN NOT {BAD} THEN CAST(ms AS VARCHAR) END AS ts, CASE WHEN NOT {BAD} THEN CAST(side = 'bid' AS INTEGER) END AS n_bids, CASE WHEN NOT {BAD} THEN CAST(side = 'ask' AS INTEGER) END AS n_asks FROM base",
    "lob_ts_carry": kept(bad_ts=True) + " SELECT seq, ets, pts FROM kept",
    "lob_ts_regressions": kept(shuffled=True) + f" SELECT {DAY}, coalesce(bool_or(ets < pts), false) AS failed, min(seq) FILTER (ets < pts) AS bad_seq, arg_min(ets, seq) FILTER (ets < pts) AS bad_ts, arg_min(pts, seq) FILTER (ets < pts) AS current_ts FROM kept GROUP BY {DAY}",
    "lob_epochs": base(first_snapshot=False) + f" SELECT {DAY}, seq, epoch FROM epochs",
    "lob_leading_drop": base(first_snapshot=False) + f" SELECT {DAY}, count(*) FILTER (epoch = 0) AS dropped, count(*) FILTER (epoch > 0) AS kept, min(seq) FILTER (epoch > 0) AS first_seq FROM epochs GROUP BY {DAY}",
    "lob_level_dedupe": """WITH r AS (
  SELECT o_orderpriority AS symbol, o_custkey AS seq, row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderkey) - 1 AS pos,
    CAST(floor(o_totalprice / 50000) AS BIGINT) * 1000000 AS px_key, CAST(o_orderkey % 3 AS DOUBLE) AS qty FROM orders)
SELECT symbol, seq, 'bid' AS side, px_key, arg_max(qty, pos) AS qty, CAST(max(pos) AS INTEGER) AS pos FROM r WHERE px_key > 0 AND (seq % 2 <> 0 OR qty > 0) GROUP BY symbol, seq, px_key""",
    "lob_level_intervals": intervals() + f" SELECT {DAY}, epoch, side, px_key, seq, next_seq, qty FROM live",
    "lob_topk_long": top(MINUTE) + f" SELECT {DAY}, seq, side, CAST(level AS INTEGER) AS level, px_key, qty FROM top",
    "lob_topk_wide": samples(FIVE) + f" SELECT {DAY}, timestamp_ms, {ALL} FROM samples",
    "lob_topk_joined": samples(FIVE) + f" SELECT {DAY}, timestamp_ms, {ALL} FROM samples",
    "lob_grid": kept() + triggers(MINUTE) + f" SELECT {DAY}, unnest(range(first_grid, last_grid + 1)) * {MINUTE} AS timestamp_ms FROM trig",
    "lob_day_rowcount": kept() + triggers(MINUTE) + f", c AS (SELECT {DAY}, CAST(sum(last_grid - first_grid + 1) AS BIGINT) AS n FROM trig GROUP BY {DAY}), e AS (SELECT {DAY}, max(ets) // {MINUTE} - min(ets) // {MINUTE} AS expected FROM kept GROUP BY {DAY}) SELECT {DAY}, coalesce(n, 0) AS sampled, expected, coalesce(n, 0) = expected AS same FROM e LEFT JOIN c USING ({DAY})",
    "lob_best_quote_samples": samples(MINUTE, 1) + f" SELECT {DAY}, timestamp_ms, bid_px_0, ask_px_0, ask_px_0 - bid_px_0 AS spread, (ask_px_0 + bid_px_0) / 2 AS mid FROM samples",
    "lob_bad_line_ratio": base() + f" SELECT {DAY}, count(*) AS total, count(*) FILTER ({BAD}) AS bad, CAST(count(*) FILTER ({BAD}) AS DOUBLE) / count(*) AS bad_share, count(*) FILTER (action = 'snapshot' AND NOT {BAD}) = 0 AS no_snapshot, count(*) FILTER (action = 'snapshot' AND NOT {BAD}) = 0 OR CAST(count(*) FILTER ({BAD}) AS DOUBLE) / count(*) > 0.001 AS failed FROM base GROUP BY {DAY}",
    "lob_schema_rows_check": kept() + triggers(FIVE) + f" SELECT CAST((SELECT sum(last_grid - first_grid + 1) FROM trig) AS BIGINT) AS rows, CAST((SELECT sum(n) FROM (SELECT max(ets) // {FIVE} - min(ets) // {FIVE} AS n FROM kept GROUP BY {DAY})) AS BIGINT) AS expected, 0 AS errors, 80 AS errors_without_prices",
    "delta_ts": coded() + f" SELECT {DAY}, timestamp_ms, timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY {DAY} ORDER BY timestamp_ms) AS step, timestamp_ms AS restored, true AS fits FROM codable",
    "delta_base": coded() + f", b AS (SELECT {DAY}, timestamp_ms, max(whole) FILTER (side = 'bid') AS bid, max(whole) FILTER (side = 'ask') AS ask FROM cell WHERE level = 0 GROUP BY ALL) SELECT *, bid - lag(bid) OVER w AS bid_step, ask - lag(ask) OVER w AS ask_step FROM b WINDOW w AS (PARTITION BY {DAY} ORDER BY timestamp_ms)",
    "delta_offsets": coded() + f" SELECT {DAY}, timestamp_ms, side, CAST(level AS INTEGER) AS level, base, CASE WHEN side = 'bid' THEN base - whole ELSE whole - base END AS \"offset\" FROM cell",
    "delta_restore": coded() + f" SELECT {DAY}, timestamp_ms, side, CAST(level AS INTEGER) AS level, px AS price FROM cell",
    "delta_verify": coded() + f" SELECT {DAY}, count(*) AS rows, CAST(count(*) FILTER ((timestamp_ms // {FIVE}) % 5 = 0) AS BIGINT) AS differing_cells FROM codable GROUP BY {DAY}",
    "delta_null_bitmap": coded() + f""", n AS (SELECT {DAY}, count(*) AS rows FROM codable GROUP BY {DAY}),
p AS (SELECT {DAY}, side, level, count(*) AS present FROM cell GROUP BY ALL),
names AS (SELECT s AS side, i AS level, k FROM (VALUES ('bid'), ('ask')) a(s), range(20) b(i), (VALUES ('px'), ('sz')) c(k))
SELECT {DAY}, names.side || '_' || k || '_' || names.level AS "column", coalesce(present, 0) AS present, rows, (rows + 7) // 8 AS bitmap_bytes FROM n CROSS JOIN names LEFT JOIN p USING ({DAY}, side, level)""",
    "delta_blob_size": coded() + f", {SIZED} SELECT * FROM blob",
    "delta_column_time": coded() + f""", names AS (SELECT s AS side, i AS level FROM (VALUES ('bid'), ('ask')) a(s), range(20) b(i)),
full_cells AS (SELECT c.symbol, c.trade_date, c.timestamp_ms, names.side, names.level, whole FROM codable c CROSS JOIN names LEFT JOIN cell x ON x.symbol = c.symbol AND x.trade_date = c.trade_date AND x.timestamp_ms = c.timestamp_ms AND x.side = names.side AND x.level = names.level),
steps AS (SELECT *, whole - lag(whole) OVER (PARTITION BY {DAY}, side, level ORDER BY timestamp_ms) AS step FROM full_cells)
SELECT {DAY}, side || '_px_' || level AS "column", min(step) AS least, max(step) AS greatest, coalesce(min(step) >= -2147483648, true) AND coalesce(max(step) <= 2147483647, true) AS fits FROM steps GROUP BY {DAY}, side, level""",
    "delta_distance": coded() + """, d AS (
  SELECT side, level, 'px' AS k, px - CAST(CAST(round_even(px * 100, 0) / 100 AS FLOAT) AS DOUBLE) AS d FROM cell UNION ALL SELECT side, level, 'sz', 0.0::DOUBLE FROM cell),
r AS (SELECT side || '_' || k || '_' || level AS "column", (side = 'ask')::INT * 40 + level * 2 + (k = 'sz')::INT AS place, max(abs(d)) AS max_abs, avg(abs(d)) AS mean_abs, sqrt(avg(d * d)) AS rmse, count(*) FILTER (d <> 0) AS nonzero, count(*) AS cells FROM d GROUP BY side, level, k)
SELECT "column", round(max_abs, 9) AS max_abs, round(mean_abs, 9) AS mean_abs, round(rmse, 9) AS rmse, nonzero, cells FROM r ORDER BY r.max_abs DESC, place LIMIT 10""",
    "delta_compression": coded() + f", {SIZED} SELECT {DAY}, blob_bytes AS bytes, rows * 328 AS original, blob_bytes / 1048576.0::DOUBLE AS mib, blob_bytes::DOUBLE / (rows * 328) AS ratio, (1 - blob_bytes::DOUBLE / (rows * 328)) * 100 AS saved_pct FROM blob",
    "task_range": ORDERS + ", s AS (SELECT symbol, min(trade_date) AS a, count(DISTINCT o_orderstatus) * 10 - 1 AS n FROM o GROUP BY symbol) SELECT symbol, CAST(unnest(range(a, a + CAST(n + 1 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS trade_date FROM s UNION ALL SELECT symbol, CAST(unnest(range(DATE '2024-01-30', DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) FROM s",
    "task_lookback": "SELECT symbol, CAST(DATE '2024-03-02' - CAST(b AS INTEGER) AS DATE) AS trade_date FROM (SELECT DISTINCT event_type AS symbol FROM events), range(1, 4) r(b)",
    "task_targets": targets(),
    "task_urls": ORDERS + " SELECT DISTINCT symbol, trade_date, 'https://static.okx.com/cdn/okx/match/orderbook/L2/400lv/daily/' || strftime(trade_date, '%Y%m%d') || '/' || symbol || '-L2orderbook-400lv-' || strftime(trade_date, '%Y-%m-%d') || '.tar.gz' AS url FROM o",
    "ledger_status": ORDERS + f", f AS (SELECT seq, ['pending', 'success', 'not_available', 'failed'][1 + seq % 4] AS download, ['pending', 'success', 'failed'][1 + (seq // 4) % 3] AS process, n_rows % 2 = 0 AS raw_deleted FROM o) SELECT *, {DERIVED} FROM f",
    "ledger_legacy": ORDERS + f""", r AS (SELECT CAST(seq AS VARCHAR) AS symbol, trade_date, coalesce({bit('seq', 3)}, false) AS downloaded, coalesce({bit('seq', 7)}, false) AS not_available, coalesce({bit('n_rows', 5)}, false) AS processed, coalesce({bit('n_rows', 11)}, false) AS validated, coalesce({bit('n_rows', 4)}, false) AS raw_deleted, CAST(coalesce(CASE WHEN seq % 2 = 0 THEN n_rows % 3 END, 0) AS INTEGER) AS download_attempts, n_rows AS rows FROM o)
SELECT *, 0 AS process_attempts, CASE WHEN not_available THEN 'not_available' WHEN downloaded THEN 'success' WHEN download_attempts > 0 THEN 'failed' ELSE 'pending' END AS download, CASE WHEN processed OR validated THEN 'success' ELSE 'pending' END AS process, downloaded AND NOT raw_deleted AS raw_present, processed OR validated AS parquet_present, 'pending' AS task_status FROM r""",
    "ledger_fold": folded() + f" SELECT {DAY}, {STATE} FROM states",
    "ledger_routing": folded("seq % 4 <> 0") + f", t AS (SELECT DISTINCT {DAY} FROM o) SELECT t.symbol, t.trade_date, CASE WHEN task_status = 'success' AND day(t.trade_date) % 3 = 0 THEN 'done' WHEN task_status = 'not_available' THEN 'skip' WHEN day(t.trade_date) % 2 = 0 AND day(t.trade_date) % 3 <> 0 THEN 'process' ELSE 'download' END AS queue FROM t LEFT JOIN states USING ({DAY})",
    "ledger_summary": folded() + f", t AS (SELECT {DAY}, min(seq) AS n FROM o GROUP BY {DAY}) SELECT n, concat_ws(',', {QUOTED('symbol')}, strftime(trade_date, '%Y-%m-%d'), task_status, coalesce(CAST(rows AS VARCHAR), ''), {QUOTED(ERROR)}) AS line FROM t JOIN states USING ({DAY})",
    "ledger_report": folded() + " SELECT count(*) FILTER (task_status = 'success') AS success_count, count(*) FILTER (task_status = 'not_available') AS not_available_count, count(*) FILTER (task_status = 'failed') AS failed_count, count(*) FILTER (task_status = 'failed') = 0 AS ok FROM states",
    "retry_backoff": ORDERS + " SELECT seq, seq % 8 AS attempt, CASE WHEN seq % 8 = 0 THEN 0 ELSE least(CAST(pow(2, seq % 8 - 1) AS BIGINT), 30) END AS wait_s FROM o",
    "not_available_cutoff": ORDERS + " SELECT seq, CASE WHEN trade_date <= DATE '1996-06-30' THEN 'not_available' ELSE 'retry' END AS outcome FROM o",
    "raw_usage": ORDERS + " SELECT count(*) AS files, CAST(coalesce(sum(CAST(floor(o_totalprice) AS BIGINT)), 0) AS BIGINT) AS bytes FROM o WHERE seq % 3 < 2",
}
ORACLES |= {
    "archive_scan": base() + f" SELECT {DAY}, count(*) AS lines, count(*) FILTER (NOT {BAD}) AS good, count(*) AS last_seq FROM base GROUP BY {DAY}",
    "archive_checks": base() + f" SELECT {DAY}, CAST(CASE WHEN day(trade_date) % 4 < 2 THEN count(*) ELSE 0 END AS BIGINT) AS lines, CAST(day(trade_date) % 4 > 0 AS BIGINT) AS errors FROM base GROUP BY {DAY}",
    "lob_line_filter": base() + f" SELECT {DAY}, count(*) AS lines, count(*) FILTER (seq % 13 <> 0 AND NOT {BAD}) AS good FROM base WHERE seq % 11 <> 0 GROUP BY {DAY}",
    "book_files_scan": samples(FIVE) + f" SELECT {DAY}, timestamp_ms, {ALL} FROM samples",
    "blob_files_scan": wide(FIVE) + f" SELECT {DAY}, last_grid * {FIVE} AS timestamp_ms, {ALL} FROM books WHERE bid_px_0 IS NOT NULL AND ask_px_0 IS NOT NULL",
    "blob_headers": coded() + f" SELECT {DAY}, count(*) AS rows, 20 AS depth, CAST(1000000 AS BIGINT) AS scale FROM codable GROUP BY {DAY}",
    "blob_transfer": coded() + f" SELECT {DAY}, 'skipped' AS again, 'done' AS copied, 'done' AS decoded, 'done' AS compared, count(*) AS rows FROM codable GROUP BY {DAY}",
    "delta_blob_roundtrip": coded() + f", {SIZED} SELECT {DAY}, rows, blob_bytes AS raw_bytes, CAST(0 AS BIGINT) AS differing_cells, true AS smaller, CAST(NULL AS VARCHAR) AS error FROM blob",
    "delta_errors": coded() + f", d AS (SELECT DISTINCT {DAY}, day(trade_date) % 9 AS n FROM codable) SELECT {DAY}, ['no', 'null best price', 'inexact price', 'wide step', 'null time', 'magic', 'cut', 'longer', 'overflow'][1 + n] AS spoilt, n > 0 AS refused FROM d",
    "delta_time_sample": coded() + f", s AS (SELECT DISTINCT {DAY}, step FROM (SELECT {DAY}, timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY {DAY} ORDER BY timestamp_ms) AS step FROM codable) WHERE step IS NOT NULL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY {DAY} ORDER BY step) AS INTEGER) AS rank FROM s) SELECT * FROM r WHERE rank <= 16",
    "delta_forms": coded() + f""", n AS (SELECT {DAY}, count(*) AS n, len(CAST(count(*) AS VARCHAR)) AS digits FROM codable GROUP BY {DAY}),
f AS (SELECT name, zip FROM (VALUES ('book'), ('steps by column'), ('base and offsets')) a(name), (VALUES (''), (', zstd 3')) b(zip))
SELECT {DAY}, name || zip AS name, CAST(CASE WHEN zip = '' AND name = 'steps by column' THEN 4 + {STEPS_HEAD} + digits + 41 * (8 + 4 * (n - 1)) + 160 * n
  WHEN zip = '' AND name = 'base and offsets' THEN 4 + {OFFSETS_HEAD} + digits + 3 * (8 + 4 * (n - 1)) + 320 * n END AS DOUBLE) AS bytes, true AS "some" FROM n CROSS JOIN f""",
    "delta_restored_book": coded() + f" SELECT {DAY}, count(*) AS rows, CAST(0 AS BIGINT) AS differing_cells FROM codable GROUP BY {DAY}",
    "task_load_targets": ORDERS + " SELECT DISTINCT symbol, trade_date FROM o",
    "task_bounds": ORDERS + " SELECT seq, n_rows % 5 >= 2 AS ok FROM o",
    "ledger_files_scan": folded("month(trade_date) <> 1", MONTHLY) + f""", t AS (SELECT DISTINCT {DAY} FROM o)
SELECT {DAY}, coalesce(download, 'pending') AS download, coalesce(process, 'pending') AS process, coalesce(download_attempts, 0) AS download_attempts, coalesce(process_attempts, 0) AS process_attempts, rows, coalesce(raw_deleted, false) AS raw_deleted, last_error,
  coalesce(downloaded, false) AS downloaded, coalesce(not_available, false) AS not_available, coalesce(processed, false) AS processed, coalesce(validated, false) AS validated, coalesce(raw_present, false) AS raw_present, coalesce(parquet_present, false) AS parquet_present, coalesce(task_status, 'pending') AS task_status
FROM t LEFT JOIN states USING ({DAY})""",
    "ledger_updates": folded(orders=FIRST) + f" SELECT {DAY}, {STATE} FROM states",
    "file_clean_up": "SELECT DISTINCT o_orderpriority AS symbol, name, length FROM orders, (VALUES ('2024-01-02.parquet', CAST(3 AS BIGINT)), ('2024-01-02.json', CAST(7 AS BIGINT))) f(name, length)",
    "daily_run": kept() + f""", lines AS (SELECT {DAY}, count(*) FILTER ({BAD}) / count(*) > 0.001 AS bad FROM base GROUP BY {DAY}),
spans AS (SELECT {DAY}, CAST(max(ets) // {FIVE} - min(ets) // {FIVE} AS BIGINT) AS n FROM kept GROUP BY {DAY}),
e AS (SELECT *, day(trade_date) % 5 = 0 AS absent, NOT bad AND n > 0 AS good FROM lines JOIN spans USING ({DAY}))
SELECT {DAY}, CASE WHEN absent THEN 'not_available' WHEN good THEN 'success' ELSE 'failed' END AS status, CAST(CASE WHEN good AND NOT absent THEN n END AS DOUBLE) AS rows, 1 AS download_attempts, CAST(NOT absent AS INTEGER) AS process_attempts, false AS raw_present FROM e""",
}

#: Queries whose result has the column trade_date.
WITH_DAY = {
    "lob_ts_regressions", "lob_epochs", "lob_leading_drop", "lob_level_intervals", "lob_topk_long", "lob_topk_wide", "lob_topk_joined", "lob_grid", "lob_day_rowcount", "lob_best_quote_samples", "lob_bad_line_ratio",
    "delta_ts", "delta_base", "delta_offsets", "delta_restore", "delta_verify", "delta_null_bitmap", "delta_blob_size", "delta_column_time", "delta_compression",
    "task_range", "task_lookback", "task_targets", "task_urls", "ledger_legacy", "ledger_fold", "ledger_routing",
    "archive_scan", "archive_checks", "lob_line_filter", "book_files_scan", "blob_files_scan", "blob_headers", "blob_transfer", "delta_blob_roundtrip", "delta_errors", "delta_time_sample", "delta_forms", "delta_restored_book",
    "task_load_targets", "ledger_files_scan", "ledger_updates", "daily_run",
}
