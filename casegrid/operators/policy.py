"""The decision policy: rules as data, folded into one expression over a row of fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..config import DEFAULT, EngineConfig
from ..functions import text as X


def rules(config: EngineConfig = DEFAULT) -> tuple[list[tuple[str, Column]], list[tuple[str, Column]]]:
    """(reason, guard) of denial and of review, in the order in which reasons are listed. A diplomatic visa is exempt
    from the soft embargo, revoked sponsors, staleness and a missing sponsor, from nothing else."""
    c = F.col
    flags, visa = X.flag_set(c("risk_flags")), F.coalesce("visa_class", F.lit(""))
    diplomat, sponsor = visa == "DIP-1", F.coalesce("sponsor_id", F.lit(""))
    given = F.coalesce(c("arrival_date") != "", F.lit(False)) & c("receipt_date").isNotNull() & ~diplomat
    arrival = X.real_date(c("arrival_date"))
    any_of = lambda names: F.arrays_overlap(flags, F.array(*map(F.lit, names)))
    deny = [
        ("disqualifying_flag", any_of(vocab.DISQUALIFYING_FLAGS)),
        ("unpaid_fee", c("fee_status") == "unpaid"),
        ("transit_visa", visa == "TRANSIT-7"),
        ("embargoed_world", c("home_world").isin(vocab.HARD_EMBARGO_WORLDS) | (c("home_world").isin(vocab.SOFT_EMBARGO_WORLDS) & ~diplomat)),
        ("revoked_sponsor", sponsor.isin(vocab.REVOKED_SPONSORS) & ~diplomat),
        ("stale_application", given & (F.datediff("receipt_date", arrival) > config.stale_days)),
    ]
    review = [
        ("unparseable_date", given & arrival.isNull()),
        ("fee_unknown", c("fee_status") == "unknown"),
        ("review_flag", any_of(vocab.REVIEW_FLAGS)),
        ("missing_visa", visa == ""),
        ("missing_sponsor", (sponsor == "") & ~diplomat),
    ]
    return deny, review


def listed(pairs: list[tuple[str, Column]]) -> Column:
    """The reasons whose guard holds, in order."""
    return F.array_compact(F.array(*[F.when(guard, F.lit(reason)) for reason, guard in pairs]))


def adjudicated(fields: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """fields (the nine values and receipt_date) with decision and reasons: denial beats review beats approval."""
    deny, review = (listed(x) for x in rules(config))
    both = fields.withColumn("_deny", deny).withColumn("_review", review)
    decision = F.when(F.size("_deny") > 0, "DENIED").when(F.size("_review") > 0, "NEEDS_REVIEW").otherwise("APPROVED")
    reasons = F.when(F.size("_deny") > 0, F.col("_deny")).when(F.size("_review") > 0, F.col("_review")).otherwise(F.array(F.lit("clean")))
    return both.withColumn("decision", decision).withColumn("reasons", reasons).drop("_deny", "_review")


def best_expected(approve: Column, deny: Column, review: Column, config: EngineConfig = DEFAULT) -> Column:
    """The decision of the highest expected score, given the chances of each being right; the first at ties."""
    values = {
        "APPROVED": approve * config.weight_correct + deny * config.weight_false_approval,
        "DENIED": deny * config.weight_correct,
        "NEEDS_REVIEW": review * config.weight_correct + (approve + deny) * config.weight_hedge,
    }
    top = F.greatest(*values.values())
    out = F.lit("NEEDS_REVIEW")
    for name in ("DENIED", "APPROVED"):
        out = F.when(values[name] == top, name).otherwise(out)
    return out


def score(decision: Column, truth: Column, config: EngineConfig = DEFAULT) -> Column:
    """Points of a decision against the truth."""
    return (
        F.when(decision == truth, config.weight_correct)
        .when(decision == "NEEDS_REVIEW", config.weight_hedge)
        .when((decision == "APPROVED") & (truth == "DENIED"), config.weight_false_approval)
        .when(truth == "NEEDS_REVIEW", config.weight_missed)
        .otherwise(0)
    )


def points(decided: DataFrame, truth: DataFrame) -> DataFrame:
    """One row, n and points of all decisions (case_id, decision) against the truth (case_id, adjudication)."""
    # counted before they meet: each row of a case_id would meet all others of it
    d, t = (rows.groupBy("case_id", c).agg(F.count(F.lit(1)).alias(k)) for rows, c, k in ((decided, "decision", "_d"), (truth, "adjudication", "_t")))
    n = F.col("_d") * F.col("_t")
    return d.join(t, "case_id").agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.sum(n * score(F.col("decision"), F.col("adjudication"))).cast("long").alias("points"))
