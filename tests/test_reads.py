"""Operators on damaged reads and pages, held against cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from casegrid.functions import fuzzy, similarity
from casegrid.functions import text as X
from casegrid.operators import admission, forensics, grammar, recovery


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_similarity_equals_the_row_by_row_one(spark):
    reads = ["Barnard-c", "Bamard-c", "", "x", "Eris Rlay", "the Eris Relay Station", "TRAPPIST-le"]
    for choice in ("Barnard-c", "Eris Relay", "TRAPPIST-1e"):
        assert column(spark, reads, lambda v: fuzzy.ratio(v, choice)) == pytest.approx([similarity.indel(r, choice) for r in reads])  # noqa: B023
        assert column(spark, reads, lambda v: fuzzy.partial(v, choice)) == pytest.approx([similarity.partial(r, choice) if r else 0.0 for r in reads])  # noqa: B023


def test_names(spark):
    reads = ["Applicant Nexdane Solvoss", "Regstry Name Nexdane Solvoss", "Nexdane Solvoss Third", "Nexdane", "nexdane solvoss", "", None]
    rows = spark.createDataFrame(list(enumerate(reads)), "i int, v string")
    got = {r["v"]: r["name"] for r in grammar.names(rows, "v").collect()}
    assert [got[x] for x in reads] == ["Nexdane Solvoss"] * 3 + [None] * 4


def test_enums_hold_embargo_worlds_to_more(spark):
    reads = ["Barnard-c", ".Bamard-c|", "TRAPPIST-2c", "TRAPPIST-1e", "not Barnard-c", "", None, "zzzz"]
    rows = spark.createDataFrame(list(enumerate(reads)), "i int, v string")
    got = {r["v"]: r["value"] for r in grammar.enums(rows, "v", "home_world").collect()}
    assert [got[x] for x in reads] == ["Barnard-c", "Barnard-c", None, "TRAPPIST-1e", None, None, None, None]


def test_flag_lists_are_never_clean_by_damage(spark):
    reads = ["none", "n0ne", "biohazard_rcd", "garbled words", "memory_tampering|active_warrant", "memory_tampering; smudge", ""]
    rows = spark.createDataFrame(list(enumerate(reads)), "i int, v string")
    got = {r["v"]: (r["value"], r["score"]) for r in grammar.flag_lists(rows, "v").collect()}
    assert [got[x] for x in reads] == [("none", 90), ("none", 90), ("biohazard_red", 85), ("none", 40), ("active_warrant|memory_tampering", 85), ("memory_tampering", 85), ("none", 90)]


def test_note_signs(spark):
    rows = [("a", 1, 1, "Manual Adjudicator Note"), ("a", 1, 2, "Finding: DENIED"), ("a", 2, 1, "Reason: none"), ("a", 3, 1, "Findings of fact"), ("a", 4, 1, None), ("a", 5, 1, "* finding. x"), ("a", 5, 2, "** Reason - y")]
    got = {r["page"]: (r["signals"], r["note_like"]) for r in grammar.note_signals(spark.createDataFrame(rows, "case_id string, page int, line_no int, text string")).collect()}
    assert got == {1: ("finding,header", True), 2: ("reason", False), 3: ("", False), 4: ("", False), 5: ("finding,reason", True)}


def test_line_kinds_stamps_and_sanitising(spark):
    assert column(spark, ["PASSPORT IMAGE", "[ washed out ]", "Packet MIB-000123 / page 2", "Home world: Luyten-b", "M.I.B."], grammar.line_kind) == ["noise", "damage", "footer", "text", "noise"]
    assert column(spark, ["a Specimen copy", "reissued", "plain", "superseded"], X.cancel_stamps) == [["COPY", "SPECIMEN"], ["REISSUED"], [], ["SUPERSEDED", "SUPERSED"]]
    assert column(spark, ["А\U000e0041B ​С", "ѕЈε"], X.sanitized) == ["ABC", "sJe"]


def test_completions_and_lookalike_fragments(spark):
    assert column(spark, ["zard_red", "ZARD_RED.", "d_red", "_red", "tics", "ngprint_x"], grammar.completion) == ["biohazard_red", "biohazard_red", "biohazard_red", None, None, None]


def test_paint(spark):
    d = "array<double>"
    assert column(spark, [[0.5], [0.1, 0.2, 0.3], [0.0, 0.25, 0.5, 0.75], [0.1, 0.2], [float("nan")], [], None], forensics.rgb, d) == [[0.5] * 3, [0.1, 0.2, 0.3], [0.25, 0.0, 0.0], None, None, None, None]
    assert column(spark, [[0.5005], [0.502], None], lambda v: forensics.same_paint(v, F.array(F.lit(0.5))), d) == [True, False, False]
    got = column(spark, ["[3 1] 0", " [3] 1.5 ", "[] 0", "[0 0] 0", "[-1 2] 0", "[a] 0", "3 1 0", None], forensics.dash)
    assert [x and (x["pattern"], x["phase"]) for x in got] == [([3.0, 1.0], 0.0), ([3.0, 3.0], 1.5), ([], 0.0), None, None, None, None, None]
    assert column(spark, ["A#20B", "#4", "##41", "plain", "#41#42c#", ""], forensics.unescaped) == ["A B", "#4", "#A", "plain", "ABc#", ""]


GOOD = dict(failed=False, images=1, soft_mask=False, bits=8, colorspace="DeviceGray", referenced=False, layers=False, decode_keys=0, smask_in_data=False, filters="FlateDecode", image_mask=False, px_wide=1240, px_high=1754, dict_wide=1240, dict_high=1754, dict_bits=8, dict_error=False, user_unit=1.0, annotations=0, clips=False, odd_colors=False, odd_fonts=False, bound=True, odd_state=False, placements=1, page_wide=595.0, page_high=842.0, x0=0.0, y0=0.0, x1=595.0, y1=842.0, rotation=0, overlays=0)
BROKEN = {
    "eligible": {}, "image_count_not_one": {"images": 2}, "image_tuple_unsupported": {"bits": 1}, "optional_content": {"layers": True}, "image_decode_ambiguity": {"decode_keys": 1}, "smask_in_data": {"smask_in_data": True},
    "image_filter_mismatch": {"filters": ""}, "image_mask": {"image_mask": True}, "image_dictionary_metadata_mismatch": {"dict_wide": 1239}, "image_dictionary_inspection_error": {"dict_error": True}, "nondefault_user_unit": {"user_unit": 2.0},
    "annotations_or_widgets": {"annotations": 1}, "clipping_or_text_clip": {"clips": True}, "unsafe_color_context": {"odd_colors": True}, "unsafe_font_context": {"odd_fonts": True}, "target_image_binding_mismatch": {"bound": False},
    "unsafe_graphics_state": {"odd_state": True}, "placement_count_not_one": {"placements": 2}, "invalid_cropbox": {"page_wide": 0.0}, "invalid_placement_rect": {"x1": 0.0}, "not_full_bleed": {"x1": 300.0}, "ambiguous_transform": {"rotation": 45},
    "insufficient_resolution": {"page_wide": 1240.0, "page_high": 1754.0, "x1": 1240.0, "y1": 1754.0}, "aspect_ratio_mismatch": {"page_wide": 500.0, "x1": 500.0}, "evidence_bearing_overlay": {"overlays": 1}, "inspection_exception": {"failed": True, "images": 2},
}


def test_every_outcome_of_the_scan_selector(spark):
    assert list(BROKEN) == forensics.OUTCOMES
    rows = spark.createDataFrame([{**GOOD, **broken, "name": name} for name, broken in BROKEN.items()] + [{**GOOD, "clips": None, "name": "clipping_or_text_clip"}, {**GOOD, "px_wide": 1754, "px_high": 1240, "dict_wide": 1754, "dict_high": 1240, "rotation": 90, "name": "eligible"}])
    got = rows.select("name", forensics.scan_outcome().alias("outcome")).collect()
    assert all(r["name"] == r["outcome"] for r in got) and len(got) == 28
    census = forensics.outcome_census(rows.select(F.col("name").alias("outcome")).where("outcome <> 'image_mask'"))
    assert sum(r["n"] for r in census.collect()) == 27 and census.where("n = 0").count() == 1 and census.count() == 26


def test_fees_and_corrections(spark):
    row = dict(page_type="fee_receipt", label=0.9, stamps=0, paid=0.9, paid_x=2, ink=0.5, unpaid=0.4, waived=0.3, unknown=0.3, paid_head=0.9, struck="")
    shifted = {**row, "paid_x": 10, "ink": 2.0, "unpaid": 0.6, "paid_head": 0.5}
    cases = [(row, "paid"), (shifted, "unpaid"), ({**row, "stamps": 1}, None), ({**row, "struck": "paid"}, None), ({**shifted, "struck": "unpaid"}, None), ({**row, "page_type": "unknown", "label": 0.5}, None), ({**row, "waived": 0.88}, None)]
    got = spark.createDataFrame([{**r, "i": i} for i, (r, _) in enumerate(cases)]).select("i", admission.fee_read().alias("x")).orderBy("i").collect()
    assert [r["x"] for r in got] == [want for _, want in cases]
    rows = [("home_world", "Eris Relay", 3, 70, "Luyten-b", -0.1, False), ("home_world", "Luyten-b", 3, 70, "Eris Relay", -0.1, True), ("home_world", "Luyten-b", 1, 70, "Titan Freeport", -0.1, False), ("home_world", "Luyten-b", 3, 88, "Titan Freeport", -0.1, False), ("fee_status", "paid", 3, 70, "unpaid", -0.01, False), ("arrival_date", "2026-05-01", 3, 70, "2026-05-02", -0.2, False)]
    table = spark.createDataFrame(rows, "field string, value string, rank int, score int, proposal string, logprob double, want boolean")
    got = table.select("want", admission.corrected(*[F.col(x) for x in ("value", "field", "rank", "score", "proposal", "logprob")]).alias("c")).collect()
    assert all(r["c"]["corrected"] == r["want"] for r in got) and {r["c"]["score"] for r in got if r["want"]} == {80.0}


def test_recovery(spark):
    states = spark.createDataFrame([(1, "a", None, 1, 0), (2, "b", "x", 1, 1), (3, "c", None, 0, 0), (4, "d", "x", 0, 0), (5, "e", None, 2, 2)], "case_no int, case_id string, error string, n_pools int, n_notes int")
    attempts = spark.createDataFrame([(1, 1, 1, "failed", "timeout"), (4, 1, 2, "failed", "memory"), (4, 2, 3, "success", None), (5, 1, 4, "success", None), (5, 2, 5, "failed", "session")], "case_no int, attempt int, event_id int, status string, failure_category string")
    assert {(r["case_id"], r["category"]) for r in recovery.retryable(states, attempts).collect()} == {("a", "timeout"), ("b", "extraction_error"), ("c", "recognizable_stub"), ("e", "session")}
    rows = [("s", i, i, n) for i, n in enumerate([9, 8, 8, 8, 7, 7, 7, 7, 1])] + [("t", 1, 1, 5), ("t", 2, 2, 5)]
    got = {r["shard"]: tuple(r)[1:] for r in recovery.strikes(spark.createDataFrame(rows, "shard string, ts int, event_id int, remaining int")).collect()}
    assert got == {"s": (8, 3, True), "t": (2, 1, False)}
    assert [r["max_pages"] for r in column(spark, [-3, 0, 1, 2, 9, None], recovery.shed, "int")] == [4, 4, 2, 0, 0, 4]
    numbered = spark.createDataFrame([(i,) for i in range(1, 12)], "ordinal long")
    order = [r["ordinal"] for r in recovery.emission_order(numbered, 4).orderBy("place").collect()]
    assert order == [x for k in range(4) for x in range(1 + k, 12, 4)]


def test_anchors_and_embargo_look_ahead(spark):
    rows = [("a", 1, 1, "HOME WORLD: X"), ("a", 2, 1, "Packet MIB-000123 / page 2"), ("a", 3, 1, "zzz"), ("a", 4, 1, "INTAKE"), ("a", 5, 1, "Home wor1d"), ("a", 6, 1, "Registry Status:"), ("a", 6, 2, "-"), ("a", 6, 3, "EMB"), ("a", 7, 1, "Registry Status: CLEAR"), ("a", 7, 4, "EMB"), ("a", 7, 2, "x"), ("a", 7, 3, "y"), ("a", 8, 1, "EMBARGO REVIEW"), ("a", 9, 1, None)]
    lines = spark.createDataFrame(rows, "case_id string, page int, line_no int, text string")
    titles = ["manualadjudicatornote", "registryextract"]
    assert {r["page"]: r["anchor"] for r in grammar.anchors(lines.where("page < 6 or page = 9"), titles).collect()} == {1: "content", 2: "wrapper", 3: "none", 4: "wrapper", 5: "content", 9: "none"}
    assert {r["page"] for r in grammar.embargo_pages(lines).collect()} == {6, 8}
