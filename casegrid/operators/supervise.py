"""Supervision of a running batch: heartbeats, pace, load levels, retries, completeness."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import DEFAULT, EngineConfig
from ..sources.materialize import materialized


def heartbeats(events: DataFrame, stale_s: int = 150, key: str = "user_id") -> DataFrame:
    """key, generation, first, last, n: runs of heartbeats without a gap over stale_s seconds; each gap starts the next
    generation. The batch form of a watchdog that restarts what has gone silent."""
    w = Window.partitionBy(key).orderBy("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = events.withColumn("at", at).withColumn("cut", F.coalesce((F.col("at") - F.lag("at").over(w)) > stale_s * 1_000_000, F.lit(False)).cast("int"))
    run = cut.withColumn("generation", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return run.groupBy(key, "generation").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))


def paces(ticks: DataFrame, window: int = 200) -> DataFrame:
    """ticks (batch_id, completed, now_s) with pace: seconds per case since the newest tick at least ``window`` cases
    back, or since the oldest one."""
    w = Window.partitionBy("batch_id").orderBy("completed")
    back = w.rangeBetween(Window.unboundedPreceding, -window)
    base_n, base_t = F.last("completed").over(back), F.last("now_s").over(back)
    first_n, first_t = F.first("completed").over(w), F.first("now_s").over(w)
    n, t = F.coalesce(base_n, first_n), F.coalesce(base_t, first_t)
    return ticks.withColumn("pace", F.when(F.col("completed") > n, (F.col("now_s") - t) / (F.col("completed") - n)))


def next_level(level: Column, ratio: Column, config: EngineConfig = DEFAULT) -> Column:
    """The level after seeing a ratio of projected to allowed time: as high as the ratio passes the up-thresholds; down
    one at a time only below the level's own down-threshold."""
    up = F.lit(0)
    for i, x in enumerate(config.governor_up):
        up = F.when(ratio >= x, i + 1).otherwise(up)
    down = F.lit(False)
    for i, x in enumerate(config.governor_down):
        down = F.when(level == i + 1, ratio < x).otherwise(down)
    return F.when(up > level, up).when(down, level - 1).otherwise(level)


def levels(ticks: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """batch_id, completed, ratio, level: an ordered fold with hysteresis over each batch's ticks (batch_id, completed,
    ratio), of any number.

    A tick maps each level to the next, and maps compose. The ticks are dealt by ranges of batch and order and written
    once; each part folds its last batch to one map, from which the driver (one row for each part) gets the level that
    every part starts with, and then each part is folded as a stream."""
    most = len(config.governor_up) + 1
    after = F.array(*(next_level(F.lit(k), F.col("ratio"), config).cast("int") for k in range(most)))
    own = ticks.select("batch_id", F.col("completed").cast("bigint").alias("completed"), F.col("ratio").cast("double").alias("ratio"))
    parts = materialized(own.orderBy("batch_id", "completed", "ratio").withColumn("part", F.spark_partition_id()))
    told = parts.select("part", "batch_id", after.alias("after"))
    kind = own.schema["batch_id"].dataType.simpleString()

    def folded(batches):
        part = first = last = at = None
        for batch in batches:
            for p, key, step in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part is None:
                    part, first = p, key
                if at is None or key != last:
                    last, at = key, list(range(most))
                at = [step[x] for x in at]
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], kinds[0]), pa.array([last], kinds[0]), pa.array([at], pa.list_(pa.int32()))], names=["part", "first", "last", "at"])

    kinds = [to_arrow_schema(own.select("batch_id").schema).field(0).type]
    level, before, starts = 0, None, {}
    for r in sorted(told.mapInArrow(folded, f"part int, first {kind}, last {kind}, at array<int>").collect(), key=lambda r: r["part"]):
        starts[r["part"]] = level if before is not None and r["first"] == before[0] else 0
        level = r["at"][starts[r["part"]] if r["first"] == r["last"] else 0]
        before = (r["last"],)

    def streamed(batches):
        level, last, started = 0, None, False
        for batch in batches:
            out = []
            part, key = (batch.column(i).to_pylist() for i in (3, 0))
            for p, k, step in zip(part, key, batch.column(4).to_pylist(), strict=True):
                if not started:
                    level, last, started = starts[p], k, True
                elif k != last:
                    level, last = 0, k
                level = step[level]
                out.append(level)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.int32())], names=["batch_id", "completed", "ratio", "level"])

    return parts.withColumn("after", after).mapInArrow(streamed, f"batch_id {kind}, completed bigint, ratio double, level int")


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; the same whatever the order of arrival."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def scheduled(packets: DataFrame, order: list[str]) -> DataFrame:
    """All packets with their ordinal in an order. A sort by ranges is written once, as its ranges are sampled anew each
    time; each part then counts on from the parts before it, so no task sees more than its range."""
    index = F.monotonically_increasing_id()
    parts = materialized(packets.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", index.bitwiseAND((1 << 33) - 1)))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    before = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    return parts.join(F.broadcast(before), "_part").withColumn("ordinal", F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def backfilled(manifest: DataFrame, states: DataFrame, key: str = "case_id") -> DataFrame:
    """Every row of the manifest with its state, or the state ``missing`` where none arrived."""
    return manifest.join(states, key, "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def retried(failed: DataFrame, retries: DataFrame, key: str = "case_id") -> DataFrame:
    """Failed rows replaced by their retries where there are any: key, status, replaced."""
    r = retries.select(key, F.col("status").alias("_status"))
    return failed.join(r, key, "left").select(key, F.coalesce("_status", "status").alias("status"), F.col("_status").isNotNull().alias("replaced"))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side: keys in one manifest alone (missing: in a only; extra: in b only). Empty if the sets are equal."""
    held = a.select(F.col(key), F.lit(True).alias("_a")).unionByName(b.select(F.col(key), F.lit(False).alias("_a")))
    sides = held.groupBy(key).agg(F.bool_or("_a").alias("_in_a"), F.bool_and("_a").alias("_only_a"))
    return sides.where("_only_a or not _in_a").select(key, F.when(F.col("_only_a"), "missing").otherwise("extra").alias("side"))


def attempt_census(attempts: DataFrame) -> DataFrame:
    """shard, case_no, n, failed, last_status, recovered: a case is recovered if its last attempt is good and one before failed."""
    rows = attempts.groupBy("shard", "case_no").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "failed").alias("failed"), F.max_by("status", "attempt").alias("last_status"))
    return rows.withColumn("recovered", (F.col("last_status") == "ok") & (F.col("failed") > 0))
