"""Fusing two independent ledgers: field by field, then decision by decision, never towards an approval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..config import DEFAULT, EngineConfig
from ..functions import text as X
from . import policy


def same_value(field: str, a: str, b: str):
    """Equality of two values of a field: flags as sets, others with case and white space folded; two nulls are equal."""
    flags = X.flag_set(F.col(a)) == X.flag_set(F.col(b))
    return F.when(F.col(field) == "risk_flags", flags).otherwise(X.folded(F.col(a)).eqNullSafe(X.folded(F.col(b))))


def fused_fields(base: DataFrame, native: DataFrame) -> DataFrame:
    """base and native: (case_id, field, value, rank, score). One row per case and field of either with the value kept
    and the rule that kept it. A missing rank counts 99 and a missing score -1, so an unread field can always be filled."""
    b = base.select("case_id", "field", F.col("value").alias("base"), F.col("rank").alias("base_rank"), F.col("score").alias("base_score"), F.lit(True).alias("in_base"))
    n = native.select("case_id", "field", F.col("value").alias("native"), F.col("rank").alias("native_rank"), F.col("score").alias("native_score"), F.lit(True).alias("in_native"))
    return _fused(b.join(n, ["case_id", "field"], "full_outer"))


def fused_ledgers(base: DataFrame, native: DataFrame) -> DataFrame:
    """The same from ledgers of one row per case (w_field: value, rank, score): they are joined before they are dealt into
    rows of fields, of which a case has either all or none."""
    sides = [("base", base), ("native", native)]
    b, n = (w.select("case_id", F.struct(*[f"w_{f}" for f in vocab.FIELDS]).alias(side)) for side, w in sides)
    part = lambda f: [x for side, _ in sides for w in [F.col(side)[f"w_{f}"]] for x in (w["value"].alias(side), w["rank"].alias(f"{side}_rank"), w["score"].alias(f"{side}_score"), F.when(F.col(side).isNotNull(), True).alias(f"in_{side}"))]
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), *part(f)) for f in vocab.FIELDS])).alias("x")
    return _fused(b.join(n, "case_id", "full_outer").select("case_id", rows).select("case_id", "x.*"))


def _fused(rows: DataFrame) -> DataFrame:
    br, nr = F.coalesce(F.col("base_rank"), F.lit(99)), F.coalesce(F.col("native_rank"), F.lit(99))
    bs, ns = F.coalesce(F.col("base_score"), F.lit(-1)), F.coalesce(F.col("native_score"), F.lit(-1))
    superset = F.size(F.array_except(X.flag_set(F.col("base")), X.flag_set(F.col("native")))) == 0
    rule = (
        F.when(same_value("field", "base", "native"), "agreement")
        .when(F.col("in_native").isNull(), "native_without_evidence")
        .when((F.col("field") == "risk_flags") & ~superset, "preserve_baseline_risk_tokens")
        .when(br >= 6, "replace_weak_baseline_evidence")
        .when((nr < br) & (ns >= bs), "native_evidence_dominates")
        .otherwise("baseline_evidence_not_dominated")
    )
    taken = F.col("rule").isin("replace_weak_baseline_evidence", "native_evidence_dominates")
    return rows.withColumn("rule", rule).select("case_id", "field", F.when(taken, F.col("native")).otherwise(F.col("base")).alias("value"), "rule", taken.alias("taken"))


def adverse(native: DataFrame) -> DataFrame:
    """native (case_id, decision, reasons, risk_flags, read_risk_flags, finding) with ``cause``: why its denial is
    evidence by itself, null if it isn't. There are two causes, a denying flag that was read, and a denying finding."""
    flag = F.arrays_overlap(X.flag_set(F.col("risk_flags")), F.array(*map(F.lit, vocab.DISQUALIFYING_FLAGS))) & F.col("read_risk_flags") & F.array_contains("reasons", "disqualifying_flag")
    cause = F.when(F.col("decision") != "DENIED", F.lit(None)).when(flag, "native_deny_trigger_risk_token").when(F.col("finding") == "DENIED", "native_denied_finding")
    return native.withColumn("cause", cause)


def reconciled(base: DataFrame, native: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """base (case_id, decision, confidence) and native (the same with cause): the decision that stands, its confidence
    and the rule. Only a review may become a denial, and only with a cause; an approval is never made here."""
    n = native.select("case_id", F.col("decision").alias("native_decision"), F.col("confidence").alias("native_confidence"), "cause")
    rows = base.select("case_id", F.col("decision").alias("base_decision"), F.col("confidence").alias("base_confidence")).join(n, "case_id", "left")
    b, m = F.col("base_decision"), F.col("native_decision")
    rule = F.lit("ablation_fields_decisions_frozen")
    if config.fusion_mode == "full":
        rule = (
            F.when(m.isNull(), "native_absent")
            .when(b == "DENIED", "baseline_denied_never_relaxed")
            .when(b == m, "same_adjudication")
            .when((b == "NEEDS_REVIEW") & (m == "DENIED") & F.col("cause").isNotNull(), "needs_review_to_denied_adverse")
            .otherwise("no_authorized_transition")
        )
    flip = F.col("rule") == "needs_review_to_denied_adverse"
    return rows.withColumn("rule", rule).select("case_id", F.when(flip, m).otherwise(b).alias("decision"), F.when(flip, F.col("native_confidence")).otherwise(F.col("base_confidence")).alias("confidence"), "rule")


def consistent(rows: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """rows (fields, receipt_date, decision, reason, confidence, signed_fee): an approval that its own fields speak
    against becomes a review at capped confidence, unless a note gave it; then an unpaid fee that the note itself
    corrects is corrected, and the rest stays. ``action`` says what was done."""
    own = rows.withColumnsRenamed({"decision": "given", "reason": "given_reason"})
    judged = policy.adjudicated(own, config)
    approved, note = F.col("given") == "APPROVED", F.col("given_reason") == "adjudicator_note"
    against = approved & (F.col("decision") != "APPROVED")
    fee = against & note & (F.col("decision") == "DENIED") & (F.size("reasons") == 1) & F.array_contains("reasons", "unpaid_fee") & F.coalesce(F.col("signed_fee").isin("paid", "waived"), F.lit(False))
    action = F.when(~against, "none").when(fee, "fee_reconciled").when(note, "preserved_finding").otherwise("review_field_conflict")
    out = judged.withColumn("action", action)
    hit = F.col("action") == "review_field_conflict"
    return out.select(
        "case_id",
        F.when(hit, "NEEDS_REVIEW").otherwise(F.col("given")).alias("decision"),
        F.when(hit, "post_fusion_field_conflict").otherwise(F.col("given_reason")).alias("reason"),
        F.when(hit, F.least(F.col("confidence"), F.lit(config.review_cap))).otherwise(F.col("confidence")).alias("confidence"),
        F.when(F.col("action") == "fee_reconciled", F.col("signed_fee")).otherwise(F.col("fee_status")).alias("fee_status"),
        "action",
    )


def rank1_conflicts(candidates: DataFrame) -> DataFrame:
    """case_id, field, n_values, n_views: fields of which the sources of rank one give more than one value."""
    first = candidates.where("rank = 1 and value <> ''")
    return first.groupBy("case_id", "field").agg(F.size(F.collect_set("value")).alias("n_values"), F.count(F.lit(1)).alias("n_views")).where("n_values > 1")


def baseline_guards(candidates: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """case_id, guards: adverse baseline reads that stand against an approval whatever a second ledger says; an arrival
    date does by its age at the receipt epoch, 170 days or more, or over 30 ahead."""
    age = F.datediff(F.lit(config.receipt_epoch), X.real_date(F.col("value")))
    f, v = F.col("field"), F.col("value")
    bad = (
        ((f == "risk_flags") & (F.size(X.flag_set(v)) > 0))
        | ((f == "fee_status") & v.isin("unpaid", "unknown"))
        | ((f == "home_world") & v.isin(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS))
        | ((f == "visa_class") & (v == "TRANSIT-7"))
        | ((f == "arrival_date") & ((age >= config.gray_zone[0]) | (age < -config.future_days)))
    )
    return candidates.where(bad).groupBy("case_id").agg(F.array_sort(F.collect_set(f)).alias("guards"))


def batch_sponsor_block(chosen: DataFrame, sponsors: DataFrame) -> DataFrame:
    """case_id, sponsor_id: cases whose sponsor is on the batch's list, and that have no unambiguous diplomatic visa."""
    wide = chosen.where(F.col("field").isin("sponsor_id", "visa_class")).groupBy("case_id").agg(
        F.max(F.when(F.col("field") == "sponsor_id", F.col("value"))).alias("sponsor_id"), F.max(F.when((F.col("field") == "visa_class") & ~F.col("ambiguous"), F.col("value"))).alias("visa")
    )
    return sponsor_block(wide, sponsors)


def sponsor_block(wide: DataFrame, sponsors: DataFrame) -> DataFrame:
    """The same from one row per case: case_id, sponsor_id, visa (null if ambiguous)."""
    return wide.join(sponsors, "sponsor_id", "left_semi").where(F.coalesce(F.col("visa"), F.lit("")) != "DIP-1").select("case_id", "sponsor_id")


def native_sanitized(native: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Native candidates inside the legal vocabularies: closed fields by membership, flags as a non-empty legal subset,
    dates on the calendar, names of exactly two tokens that both stand in the lexicon (token)."""
    f, v = F.col("field"), F.col("value")
    closed = ((f == "species_code") & v.isin(vocab.SPECIES)) | ((f == "home_world") & v.isin(vocab.WORLDS)) | ((f == "visa_class") & v.isin(vocab.VISAS)) | ((f == "fee_status") & v.isin(vocab.FEES)) | ((f == "declared_purpose") & v.isin(vocab.PURPOSES))
    flags = (f == "risk_flags") & (F.size(F.array_except(X.flag_set(v), F.array(*map(F.lit, vocab.FLAGS)))) == 0) & (F.size(X.flag_set(v)) > 0)
    other = closed | flags | ((f == "sponsor_id") & v.rlike(vocab.SPONSOR_ID)) | ((f == "arrival_date") & X.real_date(v).isNotNull())
    words = F.split(v, " ")
    names = native.where(f == "applicant_name").where(F.size(words) == 2).withColumn("_a", words[0]).withColumn("_b", words[1])
    first, second = lexicon.select(F.col("token").alias("_a")).distinct(), lexicon.select(F.col("token").alias("_b")).distinct()
    good = names.join(first, "_a", "left_semi").join(second, "_b", "left_semi").select(*native.columns)
    return native.where(f != "applicant_name").where(other).unionByName(good)
