"""Session helpers: local sessions, the package on executors, shared storage and its clean-up."""

from __future__ import annotations

import hashlib
import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_local: dict[str, str] = {}
_scratch: dict[str, str] = {}
_parts: dict[str, list[str]] = {}
_shipped: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests, the bench and the command line."""
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process."""
    return bool(re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master))


def archive() -> bytes:
    """The package and the pipeline as a zip file, equal for equal sources."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted([*ROOT.glob("bookweave/**/*.py"), *ROOT.glob("corpus_pipeline.py")]):
            z.writestr(zipfile.ZipInfo(str(path.relative_to(ROOT))), path.read_bytes())
    return out.getvalue()


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package: by its path on one machine, on a cluster by a zip file that Spark hands to each executor."""
    context = spark.sparkContext
    paths = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if str(ROOT) not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), *paths]))
    if not is_local(spark) and context.applicationId not in _shipped:
        data = archive()
        path = f"{scratch(spark)}/code/bookweave-{hashlib.sha256(data).hexdigest()[:12]}.zip"
        fs, at = hadoop_file(spark, path)
        stream = fs.create(at, True)
        stream.write(data)
        stream.close()
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    return spark


def hadoop_file(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, deleted when the driver's JVM ends; a local one only where that is unset and Spark is local."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or _local.get(app)
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local[app] = tempfile.mkdtemp(prefix="bookweave-")
    path = f"{root.rstrip('/')}/bookweave-{app}"
    if _scratch.get(app) != path:
        fs, at = hadoop_file(spark, path)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _scratch[app] = path
    return path


def shared_dir(spark: SparkSession, kind: str = "part") -> str:
    """A new folder name in the application's shared folder."""
    path = f"{scratch(spark)}/{kind}-{uuid.uuid4().hex}"
    _parts.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame, kind: str = "part") -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends at files that outlive executors."""
    path = shared_dir(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled = path
    return out


def release(*settled: DataFrame) -> None:
    """Deletes the files of settled tables that nothing reads any more."""
    for df in settled:
        _delete(df.sparkSession, [df._settled])


def parts(spark: SparkSession) -> list[str]:
    """The shared folders that this application holds now, oldest first."""
    return list(_parts.get(spark.sparkContext.applicationId, []))


def clean(spark: SparkSession, before: list[str] = (), keep: DataFrame | None = None) -> None:
    """Deletes the application's shared folders, but for those of ``before`` and the settled table ``keep``: what came after a point in time and no table reads any more."""
    kept = {*before, *([keep._settled] if keep is not None else [])}
    _delete(spark, [p for p in parts(spark) if p not in kept])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    held = _parts.get(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, at = hadoop_file(spark, path)
        fs.delete(at, True)
        if path in held:
            held.remove(path)
