"""Connected components by alternating large-star and small-star steps; all state stays in checkpointed DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v as m. The rows of one u may be many: the minimum is aggregated
    before the shuffle, and the join is one that adaptive execution splits when a key is hot. It is never a broadcast, of
    which every round would leave one in the driver."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least.hint("merge"), "u")


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of long ids -> (node, root): root is the least node reachable. Nodes without edges don't appear.

    Self-loops and repeated edges are allowed; null ends are ignored. Each round is written to the checkpoint folder,
    so lost executors cost one round at most.
    """
    now = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = _state(now)
    for _ in range(MOST_ROUNDS if before[0] else 0):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        tied = _to_least(large)
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v")))
        now = small.where("u <> v").distinct().checkpoint()
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
