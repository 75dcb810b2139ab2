"""Recovery of a batch: which states are retried and in what order, when a slice is given up, what load is shed, and
what is written for cases that never finished."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..config import DEFAULT, EngineConfig
from .supervise import scheduled

# What each level of load sheds (pages read again, of these in high quality, seconds a case).
SHED = [(0, 4, 2, True, 150), (1, 2, 1, True, 150), (2, 0, 0, False, 150), (3, 0, 0, False, 60), (4, 0, 0, False, 20)]


def retry_category(last: Column, error: Column, empty: Column) -> Column:
    """Why a state deserves a retry; null if it doesn't. ``last`` is its latest attempt, struct(status, failure_category):
    what that says stands, then an error, then for states without any record of attempts an empty content."""
    told = F.when(last["status"] == "success", F.lit(False)).otherwise(True)
    return F.when(
        F.coalesce(told, F.lit(True)),
        F.coalesce(last["failure_category"], F.when(error.isNotNull(), "extraction_error"), F.when(empty, "recognizable_stub")),
    )


def retryable(states: DataFrame, attempts: DataFrame, key: str = "case_no") -> DataFrame:
    """states (key, case_id, error, n_pools, n_notes) with the category of their retry; states without one are left out."""
    last = attempts.groupBy(key).agg(F.max_by(F.struct("status", "failure_category"), F.struct("attempt", "event_id")).alias("last"))
    category = retry_category(F.col("last"), F.col("error"), (F.col("n_pools") == 0) & (F.col("n_notes") == 0))
    return states.join(last, key, "left").select(key, "case_id", category.alias("category")).where("category is not null")


def retry_plan(candidates: DataFrame, order: list[str], config: EngineConfig = DEFAULT) -> DataFrame:
    """candidates in the order of the input with their ordinal, and what becomes of each: the first ``retry_cap`` are
    tried again, the rest keep their state for want of budget."""
    outcome = F.when(F.col("ordinal") <= config.retry_cap, "retried").otherwise("retry_budget_exhausted")
    return scheduled(candidates, order).withColumn("outcome", outcome)


def emission_order(numbered: DataFrame, slices: int) -> DataFrame:
    """Rows numbered from 1, with the place at which round-robin slices bring them out: slice by slice, in order within."""
    total = numbered.agg(F.count(F.lit(1)).alias("_total"))
    row, k = F.col("ordinal") - 1, F.lit(slices)
    own, share, more = row % k, F.floor(F.col("_total") / k), F.col("_total") % k
    before = own * share + F.least(own, more)
    return numbered.crossJoin(F.broadcast(total)).withColumn("slice", own.cast("int")).withColumn("place", before + F.floor(row / k) + 1).drop("_total")


def strikes(respawns: DataFrame, most: int = 3) -> DataFrame:
    """shard, respawns, strikes, given_up: a respawn that leaves no fewer cases than the one before is a strike, any other
    clears them; at ``most`` the slice is given up, and what follows doesn't happen."""
    w = Window.partitionBy("shard").orderBy("ts", "event_id")
    marked = respawns.withColumn("shrinks", F.coalesce(F.col("remaining") < F.lag("remaining").over(w), F.lit(True)))
    runs = marked.withColumn("run", F.sum(F.col("shrinks").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    counted = runs.withColumn("n", F.row_number().over(w)).withColumn("strikes", F.row_number().over(Window.partitionBy("shard", "run").orderBy("ts", "event_id")) - 1)
    end = F.min(F.when(F.col("strikes") == most, F.col("n")))
    ends = counted.groupBy("shard").agg(F.coalesce(end, F.max("n")).alias("respawns"), end.isNotNull().alias("given_up"), F.max_by("strikes", "n").alias("last"))
    return ends.select("shard", F.col("respawns").cast("long").alias("respawns"), F.when(F.col("given_up"), most).otherwise(F.col("last")).cast("int").alias("strikes"), "given_up")


def shed(level: Column) -> Column:
    """struct(max_pages, max_hq, scan_ocr, timeout_s) of a level of load, which is held to the levels there are."""
    held = F.least(F.greatest(F.coalesce(level, F.lit(0)), F.lit(0)), F.lit(len(SHED) - 1))
    rows = F.array(*[F.struct(F.lit(p).alias("max_pages"), F.lit(h).alias("max_hq"), F.lit(o).alias("scan_ocr"), F.lit(t).alias("timeout_s")) for _, p, h, o, t in SHED])
    return F.element_at(rows, (held + 1).cast("int"))


def timed_out(states: DataFrame) -> DataFrame:
    """states (case_id, level, seconds, decision) where a case over its level's limit becomes a failed one: a review with
    every field at its fallback."""
    late = F.col("seconds") > shed(F.col("level"))["timeout_s"]
    fields = F.array_join(F.array(*[F.lit(f"{k}={v}") for k, v in vocab.FALLBACKS.items()]), ";")
    return states.select(
        "case_id",
        F.when(late, "failed").otherwise("success").alias("status"),
        F.when(late, "case_timeout").alias("failure_category"),
        F.when(late, "NEEDS_REVIEW").otherwise(F.col("decision")).alias("decision"),
        F.when(late, fields).alias("fields"),
    )


def finalised(manifest: DataFrame, done: DataFrame, boundary: Column, key: str) -> DataFrame:
    """key, status of all of the manifest at a hard boundary: done (its first result is in time), late (it isn't) or
    missing. ``done`` has key and ts."""
    first = done.groupBy(key).agg(F.min("ts").alias("first"))
    status = F.when(F.col("first").isNull(), "missing").when(F.col("first") <= boundary, "done").otherwise("late")
    return manifest.join(first, key, "left").select(key, status.alias("status"))


def inspected(numbered: DataFrame, first_fails: Column, fails_again: Column, size: int = 48) -> DataFrame:
    """chunk, n, tries, outcome of rows numbered from 1, in chunks of ``size``: a chunk that fails is tried once more and,
    if it fails again, closed as failed for all its rows."""
    chunks = numbered.groupBy(F.floor((F.col("ordinal") - 1) / size).alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.bool_or(first_fails).alias("a"), F.bool_or(fails_again).alias("b"))
    outcome = F.when(~F.col("a"), "inspected").when(~F.col("b"), "inspected").otherwise("failed_closed")
    return chunks.select("chunk", "n", F.when(F.col("a"), 2).otherwise(1).alias("tries"), outcome.alias("outcome"))


def completions(done: DataFrame, bucket: Column) -> DataFrame:
    """shard, bucket, n, completed: results of each bucket of time and those so far, counted on without reading again."""
    counts = done.groupBy("shard", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("completed", F.sum("n").over(w))


def stitched(primary: DataFrame, retries: DataFrame, key: str) -> DataFrame:
    """key, status, origin, published: each case's retry where it has one, else its primary state. Results that hold any
    retry are published as an estimate."""
    r = retries.select(key, F.col("status").alias("_again"))
    rows = primary.join(r, key, "left").select(key, F.coalesce("_again", "status").alias("status"), F.when(F.col("_again").isNull(), "primary").otherwise("retry").alias("origin"))
    any_retry = rows.agg(F.coalesce(F.max((F.col("origin") == "retry").cast("int")), F.lit(0)).alias("_any"))
    return rows.crossJoin(F.broadcast(any_retry)).select(key, "status", "origin", F.when(F.col("_any") == 1, "estimate").otherwise("measured").alias("published"))


def common_cases(truth: DataFrame, predictions: DataFrame, ledger: DataFrame, key: str = "case_id") -> DataFrame:
    """common, without_truth, prediction_only, ledger_only, matched: how far three runs speak of the same cases. Predictions
    and ledger must have the same ones."""
    sides = [truth.select(key, F.lit(1).alias("side")), predictions.select(key, F.lit(2).alias("side")), ledger.select(key, F.lit(4).alias("side"))]
    seen = sides[0].unionByName(sides[1]).unionByName(sides[2]).distinct().groupBy(key).agg(F.sum("side").alias("in"))
    n = lambda *kinds: F.count_if(F.col("in").isin(*kinds))
    return seen.agg(n(7).alias("common"), n(2, 4, 6).alias("without_truth"), n(2, 3).alias("prediction_only"), n(4, 5).alias("ledger_only"), (n(2, 3, 4, 5) == 0).alias("matched"))


def best_reads(candidates: DataFrame) -> DataFrame:
    """case_id, field, value, score: the read with the highest score over all pages, the earliest page at ties."""
    order = F.struct("score", -F.col("ord"))
    return candidates.groupBy("case_id", "field").agg(F.max_by("value", order).alias("value"), F.max("score").alias("score"))


def mean_confidence(lines: DataFrame) -> DataFrame:
    """case_id, confidence: the mean over a case's pages of each page's mean, to two places."""
    pages = lines.groupBy("case_id", "page").agg(F.avg("conf").alias("c"))
    return pages.groupBy("case_id").agg(F.round(F.avg("c") + 1e-9, 2).alias("confidence"))


def taint_sets(authority: DataFrame, local: DataFrame) -> DataFrame:
    """case_id, token, global, ambiguous: tokens under any authority's strike, and those that only a local one names."""
    both = authority.select("case_id", "token", F.lit(True).alias("g")).unionByName(local.select("case_id", "token", F.lit(False).alias("g")))
    return both.groupBy("case_id", "token").agg(F.bool_or("g").alias("is_global")).select("case_id", "token", "is_global", (~F.col("is_global")).alias("ambiguous"))
