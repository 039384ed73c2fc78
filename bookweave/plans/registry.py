"""All registered queries of the order-book side, and their SQL.

Registered results have only types that any client reads alike: days are text, and whole numbers that
may be null are doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bookweave.plans import oracles, queries

Query = Callable[[SparkSession, str], DataFrame]
#: Whole numbers that may be null.
NULLABLE = {
    "lob_json_records": ["n_bids", "n_asks"],
    "lob_ts_carry": ["pts"],
    "lob_ts_regressions": ["bad_seq", "bad_ts", "current_ts"],
    "lob_leading_drop": ["first_seq"],
    "lob_level_intervals": ["next_seq"],
    "delta_ts": ["step"],
    "delta_base": ["bid_step", "ask_step"],
    "delta_column_time": ["least", "greatest"],
    "ledger_fold": ["rows"],
    "ledger_files_scan": ["rows"],
    "ledger_updates": ["rows"],
}


def _plain(name: str, query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.withColumns({c: df[c].cast("string" if t == "date" else "double") for c, t in df.dtypes if t == "date" or c in NULLABLE.get(name, [])})

    return run


def _plain_sql(name: str, sql: str) -> str:
    changed = [f"CAST({c} AS DOUBLE) AS {c}" for c in NULLABLE.get(name, [])]
    changed += ["CAST(trade_date AS VARCHAR) AS trade_date"] * (name in oracles.WITH_DAY)
    return f"SELECT * REPLACE ({', '.join(changed)}) FROM ({sql}) AS r" if changed else sql


QUERIES: dict[str, Query] = {name: _plain(name, query) for name, query in queries.QUERIES.items()}
ORACLES: dict[str, str] = {name: _plain_sql(name, sql) for name, sql in oracles.ORACLES.items()}
