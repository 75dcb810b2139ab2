import difflib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casegrid.functions import geometry
from casegrid.functions import similarity as Y
from casegrid.functions import text as X
from casegrid.operators import ctc


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r["x"] for r in rows.select("i", expr(F.col("s")).alias("x")).orderBy("i").collect()]


def test_dates(spark):
    assert [str(x) for x in column(spark, ["2026-02-28", "2026-02-30", "2026-7-1", "2026-07-01\n", "", None], X.real_date)] == ["2026-02-28", "None", "None", "None", "None", "None"]
    got = column(spark, ["on 2026-07-01.", "2026/7/1", "2026 02 30", "none", None], X.date_repaired)
    assert [tuple(x) if x else None for x in got] == [("2026-07-01", 90), ("2026-07-01", 80), None, None, None]


def test_ids_and_flags(spark):
    assert column(spark, ["spn - 0O12", "SPN.1234", "SPN-12", None], X.sponsor_repaired) == ["SPN-0012", "SPN-1234", None, None]
    assert column(spark, ["none", "", None, "b|a|b|none"], X.flag_set) == [[], [], [], ["a", "b"]]
    got = column(spark, ["biohazard_red, Active_Warrant", "N/A", "smudge", ""], X.flags_parsed)
    assert [tuple(x) for x in got] == [("active_warrant|biohazard_red", 90), ("none", 90), ("none", 40), ("none", 90)]


def test_grammar(spark):
    got = column(spark, ["Manual correction: home world -> Luyten-b", "manual correction: fee status -> paid / none", "Manual correction: shoe size -> 9", "Manual correction: fee status -> not paid"], X.correction)
    assert [tuple(x) if x else None for x in got] == [("home_world", "Luyten-b"), None, None, None]
    got = column(spark, ["Finding: approved", "finding : maybe", "NEEDS REVIEW", "Denied", "x"], X.finding)
    assert [tuple(x) if x else None for x in got] == [(True, "APPROVED"), (True, None), (False, "NEEDS_REVIEW"), None, None]
    assert column(spark, ["Amount paid: $12.00", "amount paid 5", "xamount paid 5", "amount paid 5x", None], X.paid_amount) == [True, True, False, False, None]
    assert column(spark, ["no paid", "unpaid", "paid", "", "not"], lambda s: X.negates(s, F.lit("paid"))) == [True, True, False, False, True]
    assert column(spark, ["a,b,c,d,e,f,g,h,i,j, DENIED", "a,b"], X.answer_key)[0]["verdict"] == "DENIED"
    assert column(spark, ["ok\n\nlast line\n", "", None], lambda s: X.error_tail(s, 4)) == ["line", "", ""]
    assert column(spark, ["1.5", "nan", "inf", "x", None], lambda s: X.number(s, 7.0)) == [1.5, 7.0, 7.0, 7.0, 7.0]
    assert column(spark, ["А​B", "plain", "Ｆull", None], lambda s: X.sanitized(X.nfkc(s))) == ["AB", "plain", "Full", None]


def test_hash_splits(spark):
    import hashlib

    ids = [f"MIB-{i:06d}" for i in range(60)]
    whole = [int(hashlib.md5(x.encode()).hexdigest(), 16) for x in ids]
    assert column(spark, ids, lambda s: X.md5_modulo(s, 5)) == [x % 5 for x in whole]
    assert column(spark, ids, lambda s: X.md5_modulo(s, 2)) == [x % 2 for x in whole]
    with pytest.raises(ValueError):
        X.md5_modulo(F.lit("a"), 3)


@given(st.text("abc", max_size=12), st.text("abcd", max_size=12))
@settings(max_examples=300, deadline=None)
def test_common_subsequence(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    assert Y.lcs(a, b) == table[-1, -1]


def test_ratios(spark):
    rows = spark.createDataFrame([("kitten", "sitting"), ("", ""), (None, "a"), ("abc", "xxabcxx"), ("b a", "a b c")], "a string, b string")
    got = rows.select(Y.indel_ratio("a", "b"), Y.partial_ratio("a", "b"), Y.token_set_ratio("a", "b"), Y.sequence_ratio("a", "b")).collect()
    assert got[0][0] == pytest.approx(800 / 13) and got[1][0] == 100 and got[2][0] is None
    assert got[3][1] == 100 and got[4][2] == 100
    assert got[0][3] == pytest.approx(100 * difflib.SequenceMatcher(None, "kitten", "sitting", autojunk=False).ratio())
    assert Y.weighted_edit("Iuna", "luna", {("l", "I"): 0.2}, {}, {}) == pytest.approx(95)
    assert Y.weighted_edit("LUNA", "luna", {}, {}, {}) == pytest.approx(70)
    snapped = column(spark, ["Luytn-b"], lambda s: Y.snap(s, ["Luyten-b", "Proxima-b"]))[0]
    assert snapped["best"] == "Luyten-b" and snapped["score"] == pytest.approx(87.5) and snapped["margin"] > 20


def test_rectangles(spark):
    row = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0, 5.0, 0.0, 20.0, 10.0)], "a_x0 double, a_y0 double, a_x1 double, a_y1 double, b_x0 double, b_y0 double, b_x1 double, b_y1 double")
    assert row.select(geometry.overlap("a_", "b_"), geometry.coverage("a_", "b_"), geometry.inside("a_", "b_")).first()[:] == (50.0, 0.5, False)
    assert column(spark, ["[3 2.5] 0", "x"], geometry.dashes) == [[3.0, 2.5], []]
    assert column(spark, [[0.5], [0.1, 0.2, 0.3], [0.0, 0.5, 1.0, 0.0], []], geometry.rgb, "array<double>") == [[0.5] * 3, [0.1, 0.2, 0.3], [1.0, 0.5, 0.0], None]


def test_forward_recursion_sums_all_paths():
    import itertools

    r = np.random.default_rng(1)
    frames = np.log(r.dirichlet(np.ones(3), 5))
    for target in ([], [1], [1, 1], [1, 2], [2, 1, 2]):
        total = 0.0
        for path in itertools.product(range(3), repeat=5):
            read = [k for k, _ in itertools.groupby(path) if k]
            if read == target:
                total += np.exp(sum(frames[t, k] for t, k in enumerate(path)))
        assert ctc.forward(frames, target) == pytest.approx(np.log(total) / max(1, len(target)))
