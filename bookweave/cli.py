"""Command line: ``run`` brings tasks to an end; ``daily`` does so for the days before one, codes and copies the books; ``delta`` codes, decodes, inspects, verifies and evaluates books; ``transfer`` codes folders."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from bookweave.operators import delta_blob, delta_columns, evaluation, replay, tasks
from bookweave.plans import daily
from bookweave.session import local_session
from bookweave.sources import book_files
from bookweave.sources.archive import filesystem


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bookweave", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="fetch, replay and write days")
    which = run.add_mutually_exclusive_group(required=True)
    which.add_argument("--symbol", action="append", default=[])
    which.add_argument("--target-file")
    run.add_argument("--start", type=date.fromisoformat, default=date(2024, 1, 1))
    run.add_argument("--end", type=date.fromisoformat, default=date.today())
    day = commands.add_parser("daily", help="the days before a date: fetch, replay, code, copy, clean up")
    day.add_argument("--symbol", action="append", required=True)
    day.add_argument("--run-date", type=date.fromisoformat, default=date.today())
    day.add_argument("--lookback-days", type=int, default=3)
    day.add_argument("--transfer-root", default="data/transfer")
    day.add_argument("--copy-books")
    day.add_argument("--copy-blobs")
    day.add_argument("--copy-logs")
    day.add_argument("--clean", action="store_true", help="delete the round's books and blobs once copied")
    day.add_argument("--verify", action="store_true")
    day.add_argument("--zstd-level", type=int, default=19)
    for one in (run, day):
        one.add_argument("--workers", default="*")
        one.add_argument("--dl-concurrency", type=int, default=4)
        one.add_argument("--dl-retries", type=int, default=5)
        one.add_argument("--raw-root", default="data/raw")
        one.add_argument("--parquet-root", default="data/parquet")
        one.add_argument("--ledger-root", default="data/ledger")
        one.add_argument("--summary-csv")
        one.add_argument("--raw-max-gb", type=float, default=70)
        one.add_argument("--retry-delay-secs", type=float, default=60)
    delta = commands.add_parser("delta", help="the delta format").add_subparsers(dest="action", required=True)
    for name in ("encode", "decode", "inspect", "verify", "evaluate"):
        one = delta.add_parser(name)
        one.add_argument("input")
        if name in ("encode", "decode"):
            one.add_argument("-o", "--output", required=True)
        if name in ("encode", "evaluate"):
            one.add_argument("--scale", type=int, default=delta_blob.SCALE)
            one.add_argument("--zstd-level", type=int, default=19)
        if name == "verify":
            one.add_argument("encoded")
        if name == "evaluate":
            one.add_argument("--restored-output")
    batch = commands.add_parser("transfer", help="code or decode all files below a folder")
    batch.add_argument("mode", choices=("encode", "decode"))
    batch.add_argument("input")
    batch.add_argument("output")
    batch.add_argument("--scale", type=int, default=delta_blob.SCALE)
    batch.add_argument("--zstd-level", type=int, default=19)
    batch.add_argument("--verify", action="store_true")
    batch.add_argument("--overwrite", action="store_true")
    batch.add_argument("--dry-run", action="store_true")
    batch.add_argument("--jobs", default="4")
    return p


def transfer(args: argparse.Namespace) -> int:
    """Prints a line for each file; 1 if any failed."""
    spark = local_session(args.jobs)
    options = {"skip_existing": not args.overwrite, "dry_run": args.dry_run}
    if args.mode == "encode":
        done = book_files.encode_tree(spark, args.input, args.output, args.scale, args.zstd_level, args.verify, **options)
    else:
        done = book_files.decode_tree(spark, args.input, args.output, **options)
    rows = done.orderBy("input").collect()  # a row for each file
    for r in rows:
        print(f"{r.status}: {r.input} -> {r.output}" + (f": {r.error}" if r.error else ""))
    return int(any(r.status == "failed" for r in rows))


def evaluate(args: argparse.Namespace) -> None:
    """Prints the sizes of six forms of a book and, if it is restored, how far the restored book is."""
    table = book_files.read_book(args.input)
    print(f"rows: {table.num_rows}")
    for row in evaluation.sizes(book_files.read_bytes(args.input), table, args.scale, args.zstd_level):
        print(f"{row['name']:34} {row['mib']:10.2f} {row['ratio'] * 100:9.2f}% {row['saved_pct']:9.2f}%")
    if args.restored_output:
        back = evaluation.read_base_offset(evaluation.base_offset_blob(table, args.scale))
        book_files.publish(args.restored_output, book_files.parquet_bytes(back))
        spark = local_session()
        left, right = (spark.read.parquet(p) for p in (args.input, args.restored_output))
        report = delta_columns.distance(left, right, ["timestamp_ms"], replay.book_columns())
        for r in [*delta_columns.totals(report).collect(), *delta_columns.worst(report).collect()]:
            print(" ".join(f"{k}={v}" for k, v in r.asDict().items()))


def delta(args: argparse.Namespace) -> dict:
    if args.action == "encode":
        packed = delta_blob.encode(book_files.read_book(args.input), args.scale, args.zstd_level)
        book_files.publish(args.output, packed)
    elif args.action == "decode":
        packed = book_files.read_bytes(args.input)
        book_files.publish(args.output, book_files.parquet_bytes(delta_blob.decode(packed)))
    elif args.action == "verify":
        packed = book_files.read_bytes(args.encoded)
        cells = delta_blob.same_bits(book_files.read_book(args.input), delta_blob.decode(packed))
        if cells:
            raise delta_blob.BlobError(f"{cells} cells differ")
    else:
        packed = book_files.read_bytes(args.input)
    return delta_blob.inspect(packed)


def wanted(spark, args: argparse.Namespace) -> list[tuple[str, date]]:
    if args.target_file:
        fs, path = filesystem(args.target_file)
        lines = fs.open_input_stream(path, compression=None).read().decode().splitlines()
        rows = tasks.load_targets(spark.createDataFrame(list(enumerate(lines, 1)), "line_no long, line string"))
        return [tuple(r) for r in rows.collect()]  # a row for each line of the file
    tasks.check_bounds(args.start, args.end)
    symbols = list(dict.fromkeys(args.symbol))
    return [(s, date.fromordinal(d)) for s in symbols for d in range(args.start.toordinal(), args.end.toordinal() + 1)]


def main(argv: list[str] | None = None, fetch: daily.Fetch = daily.fetch_http) -> int:
    args = parser().parse_args(argv)
    try:
        if args.command == "transfer":
            return transfer(args)
        if args.command == "delta" and args.action == "evaluate":
            evaluate(args)
            return 0
        if args.command == "delta":
            print(" ".join(f"{k}={v}" for k, v in delta(args).items()))
            return 0
        spark = local_session(args.workers)
        config = daily.Config(args.raw_root, args.parquet_root, args.ledger_root, args.dl_concurrency, args.dl_retries, retry_delay_s=args.retry_delay_secs, raw_max_bytes=int(args.raw_max_gb * (1 << 30)))
        if args.command == "daily":
            copies = {kind: to for kind in ("books", "blobs", "logs") if (to := getattr(args, f"copy_{kind}"))}
            report = daily.daily(spark, list(dict.fromkeys(args.symbol)), args.run_date, args.lookback_days, config, args.transfer_root, fetch, copies, args.summary_csv, args.clean, args.zstd_level, args.verify)
        else:
            todo = wanted(spark, args)
            report = daily.run(spark, todo, config, fetch)
            if args.summary_csv:
                daily.write_summary(spark, todo, config, args.summary_csv)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(" ".join(f"{k}={v}" for k, v in report.items()))
    return int(report["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
