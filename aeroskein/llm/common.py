"""Helpers that several operators share: staging, text guards and training rows."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: any run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space as characters, for trim().
SPACE = " \t\n\x0b\x0c\r"


#: Most bytes of a batch that goes to a Python worker while a table is staged: a worker holds a few times that.
BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20
#: Temporary folders by application, for sessions that name no shared folder.
_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only where a local session has none, as in tests, it is a temporary folder of this
    machine; a cluster has to name one.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        name = spark.sparkContext.applicationId
        path = _OWN[name] = _OWN.get(name) or "file://" + tempfile.mkdtemp(prefix="spark-")
    return path.rstrip("/")


#: The folder of the step that is running, if it has one of its own.
_STEP: ContextVar[str | None] = ContextVar("step", default=None)


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{_STEP.get() or scratch_dir(spark)}/{kind}-{uuid.uuid4().hex}"


@contextmanager
def step_folder(spark: SparkSession, kind: str):
    """Scratch tables made inside go to a folder of their own, which is deleted at the end.

    What is needed later has to be written elsewhere by then: nothing may refer to them still.
    """
    path = scratch_path(spark, kind)
    token = _STEP.set(path)
    try:
        yield
    finally:
        _STEP.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, kind: str = "stage", path: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder (to `path`, if given) and read it back: lineage ends there.

    A lost executor then costs a reread of files, never a rerun of what came before.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, kind)
    was = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, BATCH)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_BYTES, was)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose crc32(doc_id as text) mod 3 is 1; labels are never learned from them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most `limit` labelled rows that aren't held out.

    Rows are taken in the order of a hash of their id, so the choice neither depends on the
    layout nor on the size of the table. `limit` bounds the side that is broadcast. Of several
    texts of one id that with the smallest hash counts, of several labels the greatest.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select("doc_id", text_of().alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))


def batches(frames, rows: int):
    """Cut an iterator of pandas frames into frames of at most `rows` rows."""
    for frame in frames:
        for start in range(0, len(frame), rows):
            yield frame.iloc[start : start + rows]


#: A key of more than one in so many rows is hot; there are at most so many of them.
HOT = 1_000


def hot_keys(counts: DataFrame, key: str) -> DataFrame:
    """(key, parts) of the hot keys of `counts` (key, n): into how many parts their rows are to be dealt.

    At most HOT rows, whatever the table, so that it may go to every task.
    """
    total = counts.agg(F.sum("n").alias("_total"))
    hot = counts.join(total).where(F.col("n") * HOT > F.col("_total"))
    return staged(hot.select(key, F.ceil(F.col("n") * HOT / F.col("_total")).cast("int").alias("parts")), "hot")


def dealt(rows: DataFrame, hot: DataFrame, key: str, *by: str) -> DataFrame:
    """`rows` with the part of their key that a hash of the columns `by` deals them to, 0 if the key isn't hot."""
    parts = F.coalesce(F.col("parts"), F.lit(1))
    return rows.join(F.broadcast(hot), key, "left").withColumn("part", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("parts")


def in_parts(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """`rows`, which are one a key, once for each part of their key."""
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    return rows.join(F.broadcast(hot), key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), last))).drop("parts")
