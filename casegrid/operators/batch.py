"""Statistics of a whole batch: its receipt epoch and its frequent sponsors. Each result is one row or a small set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..config import DEFAULT, EngineConfig
from ..functions import text as X


def one_field(reads: DataFrame, field: str) -> DataFrame:
    """The candidates of one field, from reads with a column for each field."""
    return reads.select("case_id", F.lit(field).alias("field"), F.col(field).alias("value"), "score")


def order_statistics(days: DataFrame, column: str) -> DataFrame:
    """day, from, upto: for each distinct day the 0-based ranks that it takes. Days are few whatever the batch, so the
    running count over them is small."""
    counts = days.groupBy(F.col(column).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return counts.selectExpr("day", "sum(n) over (order by day) - n as `from`", "sum(n) over (order by day) as upto", "sum(n) over () as total")


def metadata_shift(cases: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """One row, shift: how far the upper median creation date lies past the reference; 0 inside the dead band, at most
    the cap, never negative. A batch without dates has shift 0."""
    ranks = order_statistics(cases.where("created is not null"), "created")
    median = ranks.where("floor(total / 2) >= `from` and floor(total / 2) < upto").agg(F.max("day").alias("day"))
    gap = F.coalesce(F.datediff("day", F.lit(config.creation_reference)), F.lit(0))
    return median.select(F.when(gap >= config.shift_dead_band, F.least(gap, F.lit(config.shift_cap))).otherwise(0).cast("int").alias("shift"))


def batch_epoch(candidates: DataFrame, cases: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """One row: n (null without dates), p90, bulk, shift, meta, epoch.

    Over the valid arrival dates read at the least score or more: p90 stands at index max(0, int(0.9 n) - 1); bulk is
    the newest date within 60 days of p90, or the one before it if it is over 45 days newer; shift is what p90 has
    moved, 0 within the dead band. The epoch is the reference moved by the larger of shift and meta, but not beyond
    bulk, nor before the reference. With fewer than 20 dates the epoch is the reference moved by the metadata alone.
    """
    texts = candidates.where((F.col("field") == "arrival_date") & (F.col("score") >= config.epoch_min_score)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    good = texts.select(X.real_date(F.col("value")).alias("day"), "n").where("day is not null")
    # one row: the dates with their numbers in order. There are no more of them than days on the calendar
    counts = good.groupBy("day").agg(F.sum("n").alias("n"))
    row = counts.agg(F.array_sort(F.collect_list(F.struct("day", "n"))).alias("days"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    k = F.greatest(F.lit(0), (F.lit(0.9) * F.col("n")).cast("int") - 1)
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("date").alias("day"))
    step = lambda a, x: F.struct((a["upto"] + x["n"]).alias("upto"), F.coalesce(a["day"], F.when(a["upto"] + x["n"] > F.col("k"), x["day"])).alias("day"))
    row = row.withColumn("k", k).withColumn("p90", F.aggregate("days", zero, step, lambda a: a["day"]))
    row = row.withColumn("near", F.filter("days", lambda x: x["day"] <= F.date_add("p90", config.epoch_bulk_days)))
    last, other = F.try_element_at("near", F.lit(-1)), F.when(F.size("near") > 1, F.try_element_at("near", F.lit(-2)))
    runner = F.when(last["n"] > 1, last["day"]).otherwise(other["day"])
    bulk = F.when(F.datediff(last["day"], runner) > config.epoch_gap_days, runner).otherwise(last["day"])
    moved = F.datediff("p90", F.lit(config.p90_reference))
    shift = F.when(moved >= config.shift_dead_band, moved).otherwise(0)
    row = row.select(F.when(F.col("n") > 0, F.col("n")).alias("n"), "p90", bulk.alias("bulk"), F.coalesce(shift, F.lit(0)).cast("int").alias("shift"))
    row = row.crossJoin(F.broadcast(metadata_shift(cases, config).withColumnRenamed("shift", "meta")))
    e0 = F.lit(config.receipt_epoch)
    thin = F.coalesce("n", F.lit(0)) < config.epoch_min_dates
    epoch = F.when(thin, F.date_add(e0, F.col("meta"))).otherwise(F.greatest(e0, F.least(F.date_add(e0, F.greatest("shift", "meta")), F.col("bulk"))))
    return row.withColumn("epoch", epoch)


def frequent_sponsors(candidates: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """sponsor_id, n_cases: sponsors read at 95 or more in at least max(4, int(0.004 n)) cases, of a batch of 100 cases
    or more; those on the static list are left out."""
    n = candidates.agg(F.countDistinct("case_id").alias("n"))
    good = candidates.where((F.col("field") == "sponsor_id") & (F.col("score") >= config.sponsor_min_score) & F.col("value").rlike(vocab.SPONSOR_ID))
    counts = good.groupBy(F.col("value").alias("sponsor_id")).agg(F.countDistinct("case_id").alias("n_cases"))
    least = F.greatest(F.lit(config.sponsor_floor), F.floor(F.lit(config.sponsor_share) * F.col("n")).cast("int"))
    return counts.crossJoin(F.broadcast(n)).where((F.col("n") >= config.sponsor_min_cases) & (F.col("n_cases") >= least) & ~F.col("sponsor_id").isin(vocab.REVOKED_SPONSORS)).select("sponsor_id", "n_cases")


def mined_sponsors(notes: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """sponsor_id, n: sponsors that notes name as revoked twice or more, occurrences counted."""
    return notes.where(F.col("mined_sponsor").rlike(vocab.SPONSOR_ID)).groupBy(F.col("mined_sponsor").alias("sponsor_id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= config.mined_min)


def batch_sponsors(candidates: DataFrame, notes: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """sponsor_id: frequent ones without the static list, and mined ones."""
    return frequent_sponsors(candidates, config).select("sponsor_id").union(mined_sponsors(notes, config).select("sponsor_id")).distinct()
