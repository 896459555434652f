"""Structured Streaming forms: incremental profiles, hours, closed nights, sessions, revisions, days."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from aeroskein.operators.frames import day_checks
from aeroskein.operators.observed import hourly_rows, merge_latest_nights, night_metrics
from aeroskein.operators.profiles import integrate_profiles


def read_stream(spark: SparkSession, root: str, schema: T.StructType, files_per_trigger: int | None = 8, bytes_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder; the checkpoint of the query that uses it is the cursor.

    A batch takes files_per_trigger files, or, if bytes_per_trigger is given, files of that size together, so
    that the number of batches follows the data and not the number of files; without either, all that is new.
    """
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if bytes_per_trigger:
        stream = stream.option("maxBytesPerTrigger", bytes_per_trigger)
    elif files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.parquet(root)


def _start(stream: DataFrame, checkpoint: str, each) -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_profiles(layers: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Integrate the profiles of each batch of whole daily files and write them under the batch's number.

    A batch that runs again overwrites its own folder, so output is written once. A batch
    without rows writes nothing.
    """

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            integrate_profiles(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return _start(layers, checkpoint, each)


def hourly_stream(layers: DataFrame, delay: str = "2 hours") -> DataFrame:
    """The hourly rows of a stream of layers, in append mode: layers become profiles, profiles become hours.

    Both aggregations keep their state by key under one watermark: a profile is done when the
    watermark passes its second, an hour when it passes its end. Rows that come later than
    `delay` behind the newest are dropped; an hour comes out once.
    """
    return hourly_rows(integrate_profiles(layers.withWatermark("ts", delay), event_time="event_time"), event_time="event_time")


def sessions(layers: DataFrame, gap: str = "30 minutes", delay: str = "2 hours") -> DataFrame:
    """Runs of a radar's times without a longer gap: first and last time and layers."""
    return layers.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("s"), "radar").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("layers"),
    ).select("radar", "first", "last", "layers")


class OpenNights(StatefulProcessor):
    """Profiles of a radar's open nights, kept until a later source date has come.

    The state of a radar is its newest source date and, for each night and batch, the rows that the
    batch brought, as an Arrow stream: a batch appends its own and reads nothing. Only when the
    date advances are the nights before it read, passed on and dropped, and the open ones, one or two, put back.
    Rows whose night is before a date that their own batch has brought already don't go through the state.
    """

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "day string")
        self.nights = handle.getListState("nights", "night string, rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.newest.get()[0] if self.newest.exists() else ""
        newest = before
        for frame in rows:
            newest = max(newest, frame["ts"].max().strftime("%Y-%m-%d"))
            night = frame["night_date"].astype(str).where(frame["night_date"].notna(), "")
            wanted = (night != "") & (night >= before)  # a night before the newest date of earlier batches has been passed on
            over = wanted & (night < newest)
            if over.any():
                yield frame.loc[over, self.names]
            still = wanted & ~over
            for name, part in frame[still].groupby(night[still]):
                self.nights.appendValue((name, _packed(part[self.names])))
        if newest == before:
            return
        self.newest.update((newest,))
        kept, closed = [], []
        for name, packed in self.nights.get():
            (closed if name < newest else kept).append((name, bytes(packed)))
        if kept:
            self.nights.put(kept)
        else:
            self.nights.clear()
        for _, packed in closed:
            yield _unpacked(packed)

    def close(self) -> None:
        pass


def _packed(frame: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_all().to_pandas(date_as_object=True)


def closed_nights(profiles: DataFrame) -> DataFrame:
    """Profiles of each night of a stream, once: as soon as its radar has a source date after it.

    A profile of a night that has been passed on is late and dropped; so is one without a night, whose
    date counts nevertheless. Needs the RocksDB state store, see `stream_closed_nights`.
    """
    names = profiles.columns
    return profiles.groupBy("radar").transformWithStateInPandas(OpenNights(names), profiles.schema, "Append", "None")


ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def stream_closed_nights(profiles: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Night metrics of closed_nights(), one folder a batch; a batch that runs again overwrites its own."""

    def each(batch: DataFrame, number: int) -> None:
        night_metrics(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    spark = profiles.sparkSession
    was = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        return _start(closed_nights(profiles), checkpoint, each)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def upsert_latest_nights(nights: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest night of each radar: stored ones merged with a batch's, a version a batch."""

    def each(batch: DataFrame, number: int) -> None:
        new = batch
        if number:
            stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{state}/version={number - 1}")
            new = merge_latest_nights(stored, batch).select(*batch.columns)
        else:
            new = merge_latest_nights(batch.limit(0), batch).select(*batch.columns)
        new.write.mode("overwrite").parquet(f"{state}/version={number}")

    return _start(nights, checkpoint, each)


def replace_revised(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Replace by object key: rows of a key (key, etag, modified) come from its newest version, however late.

    Batches land in folders of their own; `current_rows` reads the newest of each key.
    """

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/part={number}")

    return _start(rows, checkpoint, each)


def current_rows(landed: DataFrame) -> DataFrame:
    """Rows of the version of each key that was modified last, of equals the one that came last.

    An etag says only whether versions differ, never which is newer.
    """
    version = F.struct("modified", "batch", "etag")
    newest = landed.groupBy("key").agg(F.max(version).alias("_v"))
    return landed.join(newest, "key").where(version.eqNullSafe(F.col("_v"))).drop("_v", "batch", "part")


def stream_status(before: dict | None, batch_rows: int) -> dict:
    """Status after a batch: one without rows only refreshes the old status, which has to be there."""
    if batch_rows:
        return {"data_available": True, "no_change": False, "rows": batch_rows}
    if not before or not before.get("data_available"):
        raise ValueError("nothing changed, but nothing was built either")
    return before | {"no_change": True}


def day_stream(predictions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Cells and hours of each day of predictions, emitted when the next day has begun."""
    return predictions.withWatermark("hour", delay).groupBy(F.window("hour", "1 day"), "pulse").agg(
        F.count("*").alias("cells"), F.approx_count_distinct("hour", 0.01).alias("hours"),
    ).select("pulse", F.to_date("window.start").alias("day"), "cells", "hours")


def flush_days(predictions: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the days of each batch that are whole; others are an error."""

    def each(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        bad = day_checks(batch).where("not ok").limit(1).collect()
        if bad:
            raise ValueError(f"a day of predictions isn't whole: {bad[0]}")
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return _start(predictions, checkpoint, each)
