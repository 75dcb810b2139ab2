"""Queries over lines and reads at size: what is dealt, sorted and compiled, and what a long line costs."""


import re
import time

import pytest
from pyspark.sql import functions as F

from casegrid import catalogue
from casegrid.functions import similarity
from casegrid.operators import grammar, supervise

from .test_shared_ids import same, shared  # noqa: F401

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_note_signals_deal_lines_once(spark):
    told = catalogue.queries()["note_signals"](spark, SF)
    assert "Join" not in plan(told).replace("BroadcastNestedLoopJoin", "") and "ObjectHashAggregate" not in plan(told)
    reads = ["Manual Adjudicator Note", "manua1 adjudcator n0te", "", "note", "Findings of fact", "x [manual] adjudicator-note x", None]
    rows = spark.createDataFrame(list(enumerate(reads)), "i int, v string").select("i", similarity.partial_at_least(grammar.NOTE_HEADER, 70)(F.lower("v")).alias("near"))
    assert [r["near"] for r in rows.orderBy("i").collect()] == [None if x is None else bool(x) and similarity.partial(x.lower(), grammar.NOTE_HEADER) >= 70 for x in reads]


def test_long_lines_cost_what_they_are_long(spark):
    rows = spark.createDataFrame([("a" * 60_000,), ("a " * 5000 + "[ washed  out ] ",), ("lost and found",)], "v string")
    begin = time.monotonic()
    assert [r["k"] for r in rows.select(grammar.line_kind(F.col("v")).alias("k")).collect()] == ["text", "damage", "text"]
    assert time.monotonic() - begin < 10


@pytest.mark.parametrize("name", ["line_kinds", "paid_amount_indicator"])
def test_methods_are_small_enough_to_be_compiled(spark, name):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        told = catalogue.queries()[name](spark, SF)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told))) < 8000


def test_manifests_meet_in_one_aggregate(spark):
    a, b = (spark.createDataFrame([(k,) for k in ks], "k long") for ks in ([1, 1, 2, 3, None], [3, 3, 4]))
    found = supervise.set_difference(a, b, "k")
    assert {tuple(r) for r in found.collect()} == {(1, "missing"), (2, "missing"), (None, "missing"), (4, "extra")} and "Join" not in plan(found)


@pytest.mark.parametrize("name", ["leak_severity", "leak_audit", "manifest_equality", "pixel_admission", "policy_points"])
def test_cases_that_share_an_id(spark, shared, name):  # noqa: F811
    same(spark, name, shared)
