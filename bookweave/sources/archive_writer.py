"""Writes daily archives, for tests and for moving derived records through the archive reader."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from bookweave.operators.replay import DAY
from bookweave.session import shared_dir
from bookweave.sources.archive import SUFFIX
from bookweave.sources.book_files import day_path, publish


def archive(entries: Iterable[tuple[str, bytes | None]]) -> bytes:
    """A gzip-compressed tar file of (name, data); None makes a directory."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.GNU_FORMAT) as tar:
        for name, data in entries:
            info = tarfile.TarInfo(name)
            info.mode = 0o644
            if data is None:
                info.type = tarfile.DIRTYPE
            info.size = len(data or b"")
            tar.addfile(info, io.BytesIO(data or b""))
    return gzip.compress(out.getvalue(), mtime=0)


def write(lines: DataFrame, root: str | None = None, change: Callable[[str, object, bytes], bytes] | None = None) -> str:
    """lines: symbol, trade_date, seq, line. One archive of one entry for each day below root, its bytes changed by change(symbol, day, bytes); returns root."""
    root = root or shared_dir(lines.sparkSession, "archives")

    def day(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        symbol, date = table["symbol"][0].as_py(), table["trade_date"][0].as_py()
        text = "".join(f"{line}\n" for line in table["line"].to_pylist()).encode()
        data = archive([(f"{symbol}-{date}.json", text)])
        publish(day_path(root, symbol, date, SUFFIX), change(symbol, date, data) if change else data)
        return pa.table({"lines": pa.array([table.num_rows], pa.int64())})

    lines.select(*DAY, "seq", "line").groupBy(*DAY).applyInArrow(day, "lines long").agg({"lines": "sum"}).collect()
    return root
