"""Operators at their edges: ties, thresholds, missing rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from casegrid import vocab
from casegrid.config import EngineConfig
from casegrid.operators import batch, evidence, fusion, layout, policy, strikes, supervise

CANDIDATES = "case_id string, field string, value string, source string, rank int, score int, ord int"
FIELDS = "case_id string, applicant_name string, species_code string, home_world string, visa_class string, sponsor_id string, arrival_date string, declared_purpose string, risk_flags string, fee_status string, receipt_date date"


def candidates(spark, rows):
    return spark.createDataFrame(rows, CANDIDATES)


def one(df, **where):
    for k, v in where.items():
        df = df.where(F.col(k) == v)
    return df.collect()


def test_precedence_and_ties(spark):
    c = candidates(spark, [("a", "fee_status", "paid", "intake", 2, 70, 2), ("a", "fee_status", "unpaid", "fee_receipt", 2, 70, 1), ("a", "fee_status", "waived", "note", 1, 60, 3)])
    row = evidence.selected(c).first()
    assert (row["value"], row["rank"], row["ambiguous"]) == ("waived", 1, False)
    row = evidence.selected(c.where("source <> 'note'")).first()
    assert row["value"] == "unpaid" and row["ambiguous"]


def test_agreement_needs_two_sources_and_a_text_layer(spark):
    rows = [("a", "home_world", "Luyten-b", "note", 1, 90, 1), ("a", "home_world", "Proxima-b", "registry", 5, 70, 2), ("a", "home_world", "proxima-B", "unknown", 6, 95, 3)]
    row = evidence.selected(candidates(spark, rows)).first()
    assert row["overridden"] and row["value"] == "Proxima-b" and row["agreement"] == 2 and row["support"] == 95
    text = [(*rows[0][:3], "sponsor_letter", 1, 90, 1), *rows[1:]]
    assert evidence.selected(candidates(spark, text)).first()["value"] == "Luyten-b"


def test_flags_are_completed_once(spark):
    rows = [("a", "risk_flags", "none", "note", 1, 90, 1), ("a", "risk_flags", "illegible_biometrics", "unknown", 6, 79, 2), ("a", "risk_flags", "illegible_biometrics", "biometric", 3, 80, 3), ("a", "risk_flags", "active_warrant|illegible_biometrics", "registry", 5, 99, 4)]
    row = evidence.selected(candidates(spark, rows)).first()
    assert row["completed"] and row["value"] == "illegible_biometrics" and row["source"] == "biometric"


def test_digit_vote(spark):
    reads = ["SPN-1234", "SPN-1235", "SPN-1235", "SPN-9999", "bad"]
    rows = [("a", "sponsor_id", v, "unknown", 6, 90 - i, i) for i, v in enumerate(reads)]
    assert one(evidence.digit_vote(evidence.selected(candidates(spark, rows))))[0]["voted"] == "SPN-1235"
    tie = rows[:2]
    assert one(evidence.digit_vote(evidence.selected(candidates(spark, tie))))[0]["voted"] == "SPN-1234"
    guarded = [("a", "sponsor_id", v, "unknown", 6, 90 - i, i) for i, v in enumerate(["SPN-0008", "SPN-0007", "SPN-0007"])]
    assert one(evidence.digit_vote(evidence.selected(candidates(spark, guarded))))[0]["voted"] == "SPN-0008"


@pytest.mark.parametrize(
    "change, decision, reasons",
    [
        ({}, "APPROVED", ["clean"]),
        ({"risk_flags": "biohazard_red|identity_conflict", "fee_status": "unpaid"}, "DENIED", ["disqualifying_flag", "unpaid_fee"]),
        ({"visa_class": "TRANSIT-7"}, "DENIED", ["transit_visa"]),
        ({"home_world": "Wolf-1061c"}, "DENIED", ["embargoed_world"]),
        ({"home_world": "Wolf-1061c", "visa_class": "DIP-1"}, "APPROVED", ["clean"]),
        ({"home_world": "Eris Relay", "visa_class": "DIP-1"}, "DENIED", ["embargoed_world"]),
        ({"sponsor_id": "SPN-0007"}, "DENIED", ["revoked_sponsor"]),
        ({"sponsor_id": "", "visa_class": "DIP-1"}, "APPROVED", ["clean"]),
        ({"sponsor_id": ""}, "NEEDS_REVIEW", ["missing_sponsor"]),
        ({"sponsor_id": None, "visa_class": None, "fee_status": "unknown"}, "NEEDS_REVIEW", ["fee_unknown", "missing_visa", "missing_sponsor"]),
        ({"arrival_date": "2026-01-08"}, "APPROVED", ["clean"]),
        ({"arrival_date": "2026-01-07"}, "DENIED", ["stale_application"]),
        ({"arrival_date": "2026-02-30"}, "NEEDS_REVIEW", ["unparseable_date"]),
        ({"arrival_date": None, "risk_flags": None}, "APPROVED", ["clean"]),
    ],
)
def test_policy(spark, change, decision, reasons):
    row = {"case_id": "a", **vocab.FALLBACKS, "receipt_date": date(2026, 7, 7), **change}
    got = policy.adjudicated(spark.createDataFrame([tuple(row.values())], FIELDS)).first()
    assert (got["decision"], got["reasons"]) == (decision, reasons)


def test_expected_value_ties_go_to_the_first(spark):
    row = spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.1, 0.1, 0.8)], "a double, d double, r double")
    assert [x[0] for x in row.select(policy.best_expected(F.col("a"), F.col("d"), F.col("r"))).collect()] == ["APPROVED", "APPROVED", "DENIED", "NEEDS_REVIEW"]


def dated(spark, days, score=95):
    return candidates(spark, [(str(i), "arrival_date", str(d), "note", 1, score, 1) for i, d in enumerate(days)])


def by_hand(days, created, config):
    stamps = sorted(created)
    meta = (stamps[len(stamps) // 2] - config.creation_reference).days if stamps else 0
    meta = min(meta, 3650) if meta >= 14 else 0
    if len(days) < 20:
        return config.receipt_epoch + timedelta(meta)
    days = sorted(days)
    p90 = days[max(0, int(len(days) * 0.9) - 1)]
    near = [d for d in days if d <= p90 + timedelta(60)]
    bulk = near[-2] if len(near) > 1 and (near[-1] - near[-2]).days > 45 else near[-1]
    shift = max(0, (p90 - config.p90_reference).days)
    return max(config.receipt_epoch, min(config.receipt_epoch + timedelta(max(shift if shift >= 14 else 0, meta)), bulk))


@pytest.mark.parametrize("n, start, step, last, meta", [(19, 0, 1, None, 40), (20, 0, 1, None, 0), (25, 10, 2, None, 20), (37, 40, 1, 90, 0), (60, 60, 1, 50, 5), (0, 0, 1, None, None), (30, -300, 1, None, 13)])
def test_epoch(spark, n, start, step, last, meta):
    config = EngineConfig()
    days = [date(2026, 6, 1) + timedelta(start + i * step) for i in range(n)]
    if last:
        days.append(max(days) + timedelta(last))
    created = [] if meta is None else [config.creation_reference + timedelta(meta)] * 3 + [date(2020, 1, 1)] * 2
    cases = spark.createDataFrame([(str(i), d) for i, d in enumerate(created)], "case_id string, created date")
    got = batch.batch_epoch(dated(spark, days).union(dated(spark, [date(2030, 1, 1)], 89)), cases, config).collect()
    assert len(got) == 1 and got[0]["epoch"] == by_hand(days, created, config)


def test_frequent_sponsors_need_a_batch(spark):
    rows = [(str(i), "sponsor_id", "SPN-1111" if i < 5 else f"SPN-{2000 + i}", "note", 1, 96, 1) for i in range(100)]
    assert {r["sponsor_id"] for r in batch.frequent_sponsors(candidates(spark, rows)).collect()} == {"SPN-1111"}
    assert batch.frequent_sponsors(candidates(spark, rows[:99])).count() == 0


def test_strikes(spark):
    c = candidates(spark, [("a", "sponsor_id", "SPN-0001", "note", 1, 90, 1), ("a", "home_world", "Eris Relay", "note", 1, 90, 2), ("b", "sponsor_id", "SPN-0001", "note", 1, 90, 1)])
    marks = spark.createDataFrame([("a", "spn-0001", "global"), ("a", "eris relay", "local")], "case_id string, token string, scope string")
    left = {(r["case_id"], r["field"]) for r in strikes.surviving(c, marks).collect()}
    assert left == {("b", "sponsor_id")}  # Eris Relay falls as an alias of what is struck
    assert strikes.blocked_fields(strikes.with_strikes(c, marks)).count() == 0
    none = marks.limit(0)
    assert strikes.surviving(c, none).count() == 3


def test_fusion_rules(spark):
    schema = "case_id string, field string, value string, rank int, score int"
    base = spark.createDataFrame([("a", "home_world", "Luyten-b", 2, 90), ("b", "home_world", "Luyten-b", 6, 90), ("c", "home_world", "Luyten-b", 5, 70), ("d", "risk_flags", "active_warrant", 6, 70), ("f", "home_world", "LUYTEN-B ", 2, 70)], schema)
    native = spark.createDataFrame([("b", "home_world", "Proxima-b", 6, 60), ("c", "home_world", "Proxima-b", 4, 70), ("d", "risk_flags", "none", 1, 99), ("e", "home_world", "Proxima-b", 6, 60), ("f", "home_world", "Luyten-b", 1, 99)], schema)
    got = {r["case_id"]: (r["value"], r["rule"]) for r in fusion.fused_fields(base, native).collect()}
    assert got == {"a": ("Luyten-b", "native_without_evidence"), "b": ("Proxima-b", "replace_weak_baseline_evidence"), "c": ("Proxima-b", "native_evidence_dominates"), "d": ("active_warrant", "preserve_baseline_risk_tokens"), "e": ("Proxima-b", "replace_weak_baseline_evidence"), "f": ("LUYTEN-B ", "agreement")}


def test_reconciling_never_approves(spark):
    verdicts = ["APPROVED", "DENIED", "NEEDS_REVIEW"]
    rows = [(f"{b}{n}{c}", b, n, c) for b in verdicts for n in [*verdicts, None] for c in (None, "x")]
    base = spark.createDataFrame([(k, b, 0.5) for k, b, _, _ in rows], "case_id string, decision string, confidence double")
    native = spark.createDataFrame([(k, n, 0.9, c) for k, _, n, c in rows if n], "case_id string, decision string, confidence double, cause string")
    got = {r["case_id"]: r for r in fusion.reconciled(base, native).collect()}
    for k, b, n, c in rows:
        flip = (b, n) == ("NEEDS_REVIEW", "DENIED") and c is not None
        assert got[k]["decision"] == ("DENIED" if flip else b) and got[k]["confidence"] == (0.9 if flip else 0.5)
    frozen = fusion.reconciled(base, native, EngineConfig(fusion_mode="fields")).collect()
    assert all(r["decision"] == r["case_id"].split("APPROVED")[0] or r["confidence"] == 0.5 for r in frozen)


def test_governor_hysteresis(spark):
    ratios = [1.0, 1.02, 1.021, 1.0, 0.94, 1.5, 1.3, 1.27, 1.8, 1.59, 0.9, 0.9, 0.9, 0.9]
    ticks = spark.createDataFrame([(1, i, x) for i, x in enumerate(ratios)], "batch_id int, completed bigint, ratio double")
    assert [r["level"] for r in supervise.levels(ticks).orderBy("completed").collect()] == [0, 1, 1, 1, 0, 3, 3, 2, 4, 3, 2, 1, 0, 0]


def test_pace_uses_the_newest_tick_far_enough_back(spark):
    ticks = spark.createDataFrame([(1, n, float(n * n)) for n in (0, 50, 100, 150)], "batch_id int, completed bigint, now_s double")
    got = {r["completed"]: r["pace"] for r in supervise.paces(ticks, 60).collect()}
    assert got == {0: None, 50: 50.0, 100: 100.0, 150: 200.0}


def test_visibility_lists_every_reason(spark):
    rows = spark.createDataFrame([(1, 1, 0.0, 0.0, 5.0, 5.0, 1.0, 0.99, 0.0, 3), (1, 2, 0.0, 0.0, 5.0, 5.0, 9.0, 0.2, 0.18, 0), (1, 3, float("nan"), 0.0, 5.0, 5.0, 9.0, 0.2, 1.0, 0)], "page int, seq int, x0 double, y0 double, x1 double, y1 double, size double, channel double, opacity double, render_mode int")
    got = {r["seq"]: (r["reasons"], r["hidden"]) for r in layout.visibility(rows).collect()}
    assert got[1] == (["transparent", "invisible_mode", "near_white", "tiny"], True)
    assert got[2] == ([], False) and "not_finite" in got[3][0]
