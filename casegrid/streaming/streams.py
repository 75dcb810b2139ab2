"""The streaming surface: windows, sessions, deduplication and stateful heartbeats over an event stream."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.materialize import checkpoint_folder


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint folder."""
    return f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"


def events(spark: SparkSession, path: str, late: str = "10 minutes") -> DataFrame:
    """The event table as a stream with event time ``ts``; NTZ times are taken as UTC, as watermarks need instants."""
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # as a pattern, so that a single file is taken as well as a folder
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(pattern)
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there and return what it wrote. Results go to the shared checkpoint folder: complete
    results replace each other, others are appended once per batch."""
    spark = stream.sparkSession
    folder = shared_folder(spark)
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out").select(*schema.names)


def tumbling(stream: DataFrame, size: str = "1 hour") -> DataFrame:
    return stream.groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(stream: DataFrame, gap: str = "3 hours") -> DataFrame:
    return stream.groupBy("user_id", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")


def distinct(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key to arrive within the watermark."""
    return stream.dropDuplicatesWithinWatermark(keys).select(*keys)


def heartbeats(stream: DataFrame, stale_s: int) -> DataFrame:
    """user_id, n, restarts, after each batch: a stateful watchdog that counts a restart at each silence over stale_s
    seconds of event time. State is three numbers a key."""

    def watch(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n, restarts = state.get if state.exists else (None, 0, 0)
        times = sorted(t for part in parts for t in part["ts"])
        for t in times:
            at = int(t.value // 1000)
            if last is not None and at - last > stale_s * 1_000_000:
                restarts += 1
            last, n = max(at, last or at), n + 1
        state.update((last, n, restarts))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "restarts": [restarts]})

    return stream.groupBy("user_id").applyInPandasWithState(watch, "user_id long, n long, restarts long", "last long, n long, restarts long", "update", GroupStateTimeout.NoTimeout)
