import pytest
from pyspark.sql import functions as F

from casegrid import catalogue
from casegrid.operators import calibrate, columnar, evidence, strikes
from casegrid.plans.projection import frame

from .test_shared_ids import same, shared  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("most", [50, 50_000])
def test_whole_reads_give_what_candidates_give(spark, monkeypatch, most):
    monkeypatch.setattr(columnar, "CHUNK", most)
    reads, candidates, struck = (frame(spark, SF, x) for x in ("reads", "candidates", "struck"))
    marked = strikes.with_strikes(candidates, struck)
    for marks, pool in ((None, candidates), (struck, evidence.date_twins(marked.where("not struck and not tainted")))):
        old = evidence.selected(pool)
        new = columnar.selected(reads, marks)
        assert sorted(map(str, new.select(*old.drop("reads").columns).collect())) == sorted(map(str, old.drop("reads").collect()))
        wide = columnar.cases(reads, marks)
        voted = wide.where("voted is not null").select("case_id", "voted")
        assert sorted(voted.collect()) == sorted(evidence.digit_vote(old).select("case_id", "voted").collect())
        assert sorted(wide.where("n_fields is not null").select("case_id", *calibrate.FEATURES).collect()) == sorted(calibrate.features(old).select("case_id", *calibrate.FEATURES).collect())
    blocked = wide.where(F.size("blocked") > 0).select("case_id", "blocked")
    assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, strikes.blocked_fields(marked).collect()))


@pytest.mark.parametrize("name", ["support_confidence", "calibration_features", "strike_filter", "pool_union"])
def test_no_row_is_made_for_each_field(spark, name):
    assert "NestedLoopJoin" not in catalogue.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_cases_of_one_id_are_counted_before_they_meet(spark):
    decisions = spark.createDataFrame([("a", 3, "DENIED", ["x:1"], "p"), ("b", 1, "APPROVED", ["y"], "q")], "case_id string, n_cases long, decision string, reasons array<string>, path string")
    truth = spark.createDataFrame([("a", "DENIED")] * 2 + [("a", "APPROVED"), ("b", "DENIED")], "case_id string, adjudication string")
    assert {tuple(r) for r in calibrate.reason_buckets(decisions, truth).collect()} == {("DENIED", "x", 9, 6 / 9, False), ("APPROVED", "y", 1, 0.0, True)}
    assert {tuple(r) for r in calibrate.path_priors(decisions, truth).collect()} == {("p", 9, 12 / 19), ("q", 1, 6 / 11)}


@pytest.mark.parametrize("name", ["decide_gates", "decide_all_steps", "reason_buckets", "calibration_features"])
def test_decisions_of_cases_that_share_an_id(spark, shared, name):  # noqa: F811
    same(spark, name, shared)
