"""Forensics of pages: colours and dash patterns as they are painted, escaped names, why a span can't be trusted, and
whether a page is one native scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tolerance of equal paint; limits of a span's opacity, whiteness and size; edge, resolution and shape of a full-page scan.
SAME_PAINT = 1e-3
LEAST_OPACITY, NEAR_WHITE, LEAST_SIZE, COVERED = 0.18 - 1e-6, 0.97, 2.5, 0.6
EDGE, LEAST_RESOLUTION, MOST_STRETCH = 1e-4, 1.5, 0.02

# The outcomes of the scan selector in their order.
OUTCOMES = [
    "eligible",
    "image_count_not_one",
    "image_tuple_unsupported",
    "optional_content",
    "image_decode_ambiguity",
    "smask_in_data",
    "image_filter_mismatch",
    "image_mask",
    "image_dictionary_metadata_mismatch",
    "image_dictionary_inspection_error",
    "nondefault_user_unit",
    "annotations_or_widgets",
    "clipping_or_text_clip",
    "unsafe_color_context",
    "unsafe_font_context",
    "target_image_binding_mismatch",
    "unsafe_graphics_state",
    "placement_count_not_one",
    "invalid_cropbox",
    "invalid_placement_rect",
    "not_full_bleed",
    "ambiguous_transform",
    "insufficient_resolution",
    "aspect_ratio_mismatch",
    "evidence_bearing_overlay",
    "inspection_exception",
]


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def rgb(color: Column) -> Column:
    """A grey, RGB or CMYK colour as [red, green, blue]; null for other lengths and for what isn't finite."""
    at = lambda k: F.element_at(color, k)
    ink = lambda k: 1 - F.least(F.lit(1.0), at(k) + at(4))
    made = F.when(F.size(color) == 1, F.array(at(1), at(1), at(1))).when(F.size(color) == 3, color).when(F.size(color) == 4, F.array(ink(1), ink(2), ink(3)))
    return F.when(F.forall(color, finite), made)


def same_paint(left: Column, right: Column) -> Column:
    """Whether two colours are painted alike; a colour that can't be read is like none."""
    a, b = rgb(left), rgb(right)
    far = F.exists(F.zip_with(a, b, lambda x, y: F.abs(x - y) > SAME_PAINT), lambda x: x)
    return F.coalesce(~far, F.lit(False))


DASH = r"^\[([^\]]*)\]\s+([+-]?(?:\d+(?:\.\d*)?|\.\d+))$"


def dash(s: Column) -> Column:
    """struct(pattern, phase) of a dash string such as "[3 1] 0"; an odd pattern is repeated. Null if it isn't one, has a
    negative part or no length."""
    t = F.trim(s)
    parts = F.transform(F.filter(F.split(F.regexp_extract(t, DASH, 1), r"\s+"), lambda x: x != ""), lambda x: x.try_cast("double"))
    good = t.rlike(DASH) & F.forall(parts, lambda x: finite(x) & (x >= 0)) & ((F.size(parts) == 0) | (F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) > 0))
    pattern = F.when(F.size(parts) % 2 == 1, F.concat(parts, parts)).otherwise(parts)
    return F.when(good, F.struct(pattern.alias("pattern"), F.regexp_extract(t, DASH, 2).try_cast("double").alias("phase")))


def unescaped(s: Column) -> Column:
    """A name with its #xx escapes decoded; a # without two hexadecimal digits stays."""
    parts = F.split(s, "#")
    decoded = lambda x: F.concat(F.char(F.conv(F.substr(x, F.lit(1), F.lit(2)), 16, 10).cast("int")), F.substr(x, F.lit(3)))
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x: F.when(x.rlike("^[0-9A-Fa-f]{2}"), decoded(x)).otherwise(F.concat(F.lit("#"), x)))
    return F.concat(F.element_at(parts, 1), F.array_join(rest, ""))


def span_reasons(spans: DataFrame, pages: DataFrame, covers: DataFrame) -> DataFrame:
    """page, seq, reasons of every span: all that hold of its own numbers, of its page's inventories, and of what is
    painted over or under it, in a fixed order. Spans have a sequence number or, where that is null, an unknown place;
    covers have page, seq, kind, simple, channel and a rectangle."""
    c = F.col
    sides = [c(f"t.{x}") for x in ("x0", "y0", "x1", "y1")]
    t = spans.alias("t")
    v = covers.alias("v")
    width, height = F.least("t.x1", "v.x1") - F.greatest("t.x0", "v.x0"), F.least("t.y1", "v.y1") - F.greatest("t.y0", "v.y0")
    area = (c("t.x1") - c("t.x0")) * (c("t.y1") - c("t.y0"))
    hides = F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0)) >= COVERED * area
    holds = (c("v.x0") <= c("t.x0")) & (c("v.y0") <= c("t.y0")) & (c("v.x1") >= c("t.x1")) & (c("v.y1") >= c("t.y1"))
    later, earlier = c("v.seq") > c("t.paint_seq"), c("v.seq") < c("t.paint_seq")
    behind = earlier & holds & c("v.kind").isin("fill", "image")
    met = t.join(v, c("t.page") == c("v.page")).groupBy("t.page", "t.seq").agg(
        *[F.bool_or(later & hides & (c("v.kind") == k)).alias(k) for k in ("image", "text", "stroke")],
        F.bool_or(later & hides & (c("v.kind") == "fill") & c("v.simple")).alias("fill"),
        F.bool_or(c("t.paint_seq").isNull() & hides).alias("unordered"),
        F.max_by(c("v.simple") & (F.abs(c("v.channel") - c("t.channel")) <= SAME_PAINT), F.when(behind, c("v.seq"))).alias("same"),
    )
    own = t.join(pages.alias("p"), c("t.page") == c("p.page")).join(met.alias("m"), (c("m.page") == c("t.page")) & (c("m.seq") == c("t.seq")), "left")
    known = reduce(lambda a, b: a & b, [finite(x) for x in (*sides, c("t.size"), c("t.opacity"), c("t.channel"))])
    off = (c("t.x0") < -1e-3) | (c("t.y0") < -1e-3) | (c("t.x1") > c("p.width") + 1e-3) | (c("t.y1") > c("p.height") + 1e-3)
    reasons = [
        ("nonfinite_span_metadata", ~known),
        ("paint_inventory_ambiguous", ~c("p.paint_valid")),
        ("drawing_inventory_ambiguous", ~c("p.drawings_valid")),
        ("unresolved_clip_state", c("p.clips")),
        ("unresolved_transparency", c("p.transparency")),
        ("untrusted_font_context", c("p.odd_fonts")),
        ("opacity0", c("t.opacity") == 0),
        ("low_opacity", (c("t.opacity") > 0) & (c("t.opacity") < LEAST_OPACITY)),
        ("invisible_render_mode", c("t.render_mode") > 1),
        ("white_text", c("t.channel") >= NEAR_WHITE),
        ("off_crop", off),
        ("microtext", c("t.size") < LEAST_SIZE),
        ("under_image", c("m.image")),
        ("under_text", c("m.text")),
        ("under_fill", c("m.fill")),
        ("no_visible_color_contrast", c("m.same")),
        ("under_stroke", c("m.stroke")),
        ("paint_order_ambiguous", c("m.unordered")),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(guard, F.lit(False)), F.lit(name)) for name, guard in reasons]))
    return own.select(c("t.page").alias("page"), c("t.seq").alias("seq"), F.array_join(found, ",").alias("reasons"))


def scan_outcome() -> Column:
    """Why a page isn't one native scan that fills it: the first of the selector's rules that it breaks, or eligible. What
    can't be looked into breaks the rule, as does a value that is missing."""
    c = F.col
    yes = lambda x: F.coalesce(x, F.lit(True))  # noqa: E731  a missing answer rejects
    turned = c("rotation").isin(90, 270)
    shown_w, shown_h = F.when(turned, c("px_high")).otherwise(c("px_wide")), F.when(turned, c("px_wide")).otherwise(c("px_high"))
    rules = [
        ("image_count_not_one", c("images") != 1),
        ("image_tuple_unsupported", c("soft_mask") | (c("bits") != 8) | ~c("colorspace").isin("DeviceGray", "DeviceRGB") | c("referenced")),
        ("optional_content", c("layers")),
        ("image_decode_ambiguity", c("decode_keys") > 0),
        ("smask_in_data", c("smask_in_data")),
        ("image_filter_mismatch", c("filters") == ""),
        ("image_mask", c("image_mask")),
        ("image_dictionary_metadata_mismatch", (c("dict_wide") != c("px_wide")) | (c("dict_high") != c("px_high")) | (c("dict_bits") != 8)),
        ("image_dictionary_inspection_error", c("dict_error")),
        ("nondefault_user_unit", c("user_unit") != 1.0),
        ("annotations_or_widgets", c("annotations") > 0),
        ("clipping_or_text_clip", c("clips")),
        ("unsafe_color_context", c("odd_colors")),
        ("unsafe_font_context", c("odd_fonts")),
        ("target_image_binding_mismatch", ~c("bound")),
        ("unsafe_graphics_state", c("odd_state")),
        ("placement_count_not_one", c("placements") != 1),
        ("invalid_cropbox", ~finite(c("page_wide")) | ~finite(c("page_high")) | (c("page_wide") <= 0) | (c("page_high") <= 0)),
        ("invalid_placement_rect", (c("x1") <= c("x0")) | (c("y1") <= c("y0"))),
        ("not_full_bleed", (F.abs("x0") > EDGE) | (F.abs("y0") > EDGE) | (F.abs(c("x1") - c("page_wide")) > EDGE) | (F.abs(c("y1") - c("page_high")) > EDGE)),
        ("ambiguous_transform", ~c("rotation").isin(0, 90, 180, 270)),
        ("insufficient_resolution", F.least(shown_w / c("page_wide"), shown_h / c("page_high")) < LEAST_RESOLUTION),
        ("aspect_ratio_mismatch", F.abs(shown_w * c("page_high") / (shown_h * c("page_wide")) - 1) > MOST_STRETCH),
        ("evidence_bearing_overlay", c("overlays") > 0),
    ]
    out = F.when(yes(c("failed")), "inspection_exception")
    for name, broken in rules:
        out = out.when(yes(broken), name)
    return out.otherwise("eligible")


def outcome_census(outcomes: DataFrame) -> DataFrame:
    """rung, outcome, n of all outcomes there are, with 0 where none was met."""
    spark = outcomes.sparkSession
    listed = spark.createDataFrame(list(enumerate(OUTCOMES)), "rung int, outcome string")
    counts = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(listed).join(counts, "outcome", "left").select("rung", "outcome", F.coalesce("n", F.lit(0)).alias("n"))
