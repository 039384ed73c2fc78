"""What the training-data operators share: table access, shared storage, native word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave import session

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's own size of the batches that go to Python workers, and the one used here: whole texts are large rows.
ARROW_BYTES, ARROW_DEFAULT, ARROW_SMALL = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", str(4 << 20)


def tuned(spark: SparkSession) -> SparkSession:
    """Keeps Arrow batches small, unless the session has a size of its own; tasks then hold a few MB of text, or one longer document."""
    if spark.conf.get(ARROW_BYTES) == ARROW_DEFAULT:
        spark.conf.set(ARROW_BYTES, ARROW_SMALL)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends at files that outlive executors."""
    tuned(df.sparkSession)
    return session.settle(df, "llm")


#: Bytes, as JSON text, up to which a table of the driver's or of intermediate results travels to all tasks.
CARRIED = 32 << 20


def carried(df: DataFrame, most: int | None = None) -> DataFrame:
    """df, for a join without a shuffle of the other side where its rows are small enough together; else for one by exchange."""
    return F.broadcast(df) if travels(df, most) else df


def travels(df: DataFrame, most: int | None = None) -> bool:
    """Whether all rows of df, measured as JSON text, have at most ``most`` bytes (``CARRIED`` if None)."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))), F.lit(0))).first()[0]
    return size <= (CARRIED if most is None else most)


def boxed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """docs as one column _row, with more beside it; whatever names docs has, an operator's own can't clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *more)


def unboxed(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null; counts word ends without building the words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_rest(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; 2 marks held-out rows."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_rest(doc_id) == 2, F.lit(False))
