"""Admission of further readings: pixel reads that fill empty fields, classifiers of single values, corrected reads, and
the blockers that an approval must not lift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..config import DEFAULT, EngineConfig

# Fields whose pixel reads are precise enough, with their least match and lead; values that could only help
# an approval and so need a second channel; how a pixel read is ranked and scored.
GATES = {"species_code": (0.45, 0.08), "home_world": (0.55, 0.12)}
APPROVE_ENABLING = [("fee_status", "paid"), ("fee_status", "waived"), ("risk_flags", "none")]
PIXEL_RANK, FLAG_CAP = 6, 84.0
# Least log-probability at which a corrected read is taken, by field.
CORRECTABLE = {"species_code": -0.30, "home_world": -0.30, "visa_class": -0.30, "declared_purpose": -0.30, "arrival_date": -0.10}
# Limits of the fee classifier.
FEE = {"receipt": 0.80, "paid": 0.60, "paid_unknown": 0.70, "paid_x": 6, "paid_ink": 1.5, "paid_margin": 0.06, "shifted": 0.82, "whole": 0.50, "x_least": 8, "x_most": 13, "ink_least": 1.5, "head_drop": 0.05, "waived_margin": 0.12}
# Limits of the two-view world reader.
WORLD_NCC, WORLD_X = 0.50, 20


def triggers_denial(field: Column, value: Column) -> Column:
    """Whether a value by itself leads to a denial."""
    return (
        ((field == "visa_class") & (value == "TRANSIT-7"))
        | ((field == "home_world") & value.isin(vocab.SOFT_EMBARGO_WORLDS + vocab.HARD_EMBARGO_WORLDS))
        | ((field == "fee_status") & (value == "unpaid"))
        | ((field == "sponsor_id") & value.isin(vocab.REVOKED_SPONSORS))
    )


def pixel_reads(reads: DataFrame, pools: DataFrame, struck: DataFrame, absent: DataFrame) -> DataFrame:
    """case_id, field, value, rank, score of admitted pixel reads (case_id, field, value, ncc, margin, confirmed).

    Only a field that no other source has read and that isn't marked absent is filled. A read passes its field's gate (a
    field without one never does), isn't a struck value, and is confirmed by a second channel where it could help an
    approval. Registry reads only block.
    """
    gate = F.lit(False)
    for field, (ncc, margin) in GATES.items():
        gate = gate | ((F.col("field") == field) & (F.col("ncc") >= ncc) & (F.col("margin") >= margin))
    enabling = F.lit(False)
    for field, value in APPROVE_ENABLING:
        enabling = enabling | ((F.col("field") == field) & (F.col("value") == value))
    passed = reads.where(gate & (~enabling | F.col("confirmed")))
    # other fields never pass, so what blocks them isn't dealt; what blocks a field in either way is one set
    taken = pools.select("case_id", "field").unionByName(absent.select("case_id", "field")).where(F.col("field").isin(*GATES)).distinct()
    empty = passed.join(taken, ["case_id", "field"], "left_anti")
    named = struck.select("case_id", F.lower("token").alias("token")).distinct()
    clean = empty.withColumn("token", F.lower("value")).join(named, ["case_id", "token"], "left_anti")
    score = 60.0 + F.least(F.lit(30.0), 200.0 * F.col("margin"))
    return clean.select("case_id", "field", "value", F.lit(PIXEL_RANK).alias("rank"), F.when(F.col("field") == "risk_flags", F.least(score, F.lit(FLAG_CAP))).otherwise(score).alias("score"))


def fee_read() -> Column:
    """The fee status that a receipt's matches prove, or null. "unpaid" is a strong "paid" that stands further right with
    ink before it; "paid" stands at the head with none. Stamped pages and struck values prove nothing."""
    c, f = F.col, FEE
    receipt = ((c("page_type") == "fee_receipt") | ((c("page_type") == "unknown") & (c("label") >= f["receipt"]))) & (c("stamps") == 0)
    unpaid = (
        (c("paid") >= f["shifted"])
        & c("paid_x").between(f["x_least"], f["x_most"])
        & (c("ink") >= f["ink_least"])
        & (c("unpaid") >= f["whole"])
        & (c("paid") - c("waived") >= f["waived_margin"])
        & (c("paid") > c("unknown"))
        & (c("paid_head") <= c("paid") - f["head_drop"])
    )
    floor = F.when(c("page_type") == "unknown", f["paid_unknown"]).otherwise(f["paid"])
    paid = (
        (c("paid") >= floor)
        & (c("paid_x") <= f["paid_x"])
        & (c("ink") <= f["paid_ink"])
        & (c("paid_head") >= floor - 0.02)
        & (c("paid") - F.greatest("waived", "unknown", "unpaid") >= f["paid_margin"])
    )
    return F.when(receipt & unpaid & (c("struck") != "unpaid"), "unpaid").when(receipt & paid & (c("struck") != "paid"), "paid")


def world_read(world: Column, raw: Column, stretched: Column, raw_x: Column, stretched_x: Column) -> Column:
    """struct(value, score) of an embargo world that both views of a strip show at its head; null otherwise."""
    banned = world.isin(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS)
    good = (raw >= WORLD_NCC) & (stretched >= WORLD_NCC) & (raw_x <= WORLD_X) & (stretched_x <= WORLD_X)
    return F.when(banned & good, F.struct(world.alias("value"), F.round(F.least(F.lit(92.0), 70.0 + raw * 30.0), 1).alias("score")))


def corrected(value: Column, field: Column, rank: Column, score: Column, proposal: Column, logprob: Column, config: EngineConfig = DEFAULT) -> Column:
    """struct(value, score, corrected): a weak read of a correctable field gives way to a likely proposal. What outranks
    others stays, and a value that leads to a denial is never replaced by one that doesn't."""
    likely = F.lit(False)
    for name, least in CORRECTABLE.items():
        likely = likely | ((field == name) & (logprob >= least))
    lifts = triggers_denial(field, value) & ~triggers_denial(field, proposal)
    takes = F.coalesce((rank > 1) & (score < config.weak_read_score) & likely & (proposal != value) & ~lifts, F.lit(False))
    return F.struct(F.when(takes, proposal).otherwise(value).alias("value"), F.when(takes, F.greatest(score.cast("double"), F.lit(80.0))).otherwise(score.cast("double")).alias("score"), takes.alias("corrected"))


def preserved_blocker(guards: Column, sponsor_blocked: Column, embargo: Column, absent: Column, exempt: Column) -> Column:
    """Whether an approval that only a native note finds stays under review: baseline guards, a sponsor blocked by the
    batch, a registry's embargo, an arrival date marked absent, or an absent sponsor in a case that needs one."""
    no_date, no_sponsor = F.array_contains(absent, "arrival_date"), F.array_contains(absent, "sponsor_id")
    return (guards > 0) | sponsor_blocked | embargo | no_date | (no_sponsor & ~exempt)
