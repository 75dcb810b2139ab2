"""Visibility of text on a page: reasons to hide a span, covers painted over it, the background behind it.

Range joins carry the page as an equality and the order of painting as a range, so a page's rows meet only each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry

# What makes a span unreadable.
LEAST_OPACITY, LEAST_SIZE, NEAR_WHITE, COVERED = 0.18, 2.5, 0.97, 0.6
CROP = (0.0, 0.0, 380.0, 560.0)


def visibility(spans: DataFrame, crop: tuple[float, float, float, float] = CROP) -> DataFrame:
    """spans with reasons (each that holds, in order) and hidden."""
    c = F.col
    sides = [c(s) for s in ("x0", "y0", "x1", "y1")]
    finite = sides[0].isNotNull()
    for s in sides:
        finite = finite & s.isNotNull() & ~F.isnan(s) & (F.abs(s) < float("inf"))
    reasons = [
        ("transparent", c("opacity") == 0),
        ("faint", (c("opacity") > 0) & (c("opacity") < LEAST_OPACITY - 1e-6)),
        ("invisible_mode", c("render_mode") > 1),
        ("near_white", c("channel") >= NEAR_WHITE),
        ("outside_crop", (c("x0") < crop[0] - 1e-3) | (c("y0") < crop[1] - 1e-3) | (c("x1") > crop[2] + 1e-3) | (c("y1") > crop[3] + 1e-3)),
        ("tiny", c("size") < LEAST_SIZE),
        ("not_finite", ~finite),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(guard, F.lit(False)), F.lit(name)) for name, guard in reasons]))
    return spans.withColumn("reasons", found).withColumn("hidden", F.size("reasons") > 0)


def _pairs(spans: DataFrame, paint: DataFrame) -> DataFrame:
    side = lambda df, p: df.select("page", *[F.col(x).alias(f"{p}{x}") for x in ("seq", "x0", "y0", "x1", "y1", "channel")])
    return side(spans, "t_").join(side(paint, "c_"), "page")


def covered(spans: DataFrame, paint: DataFrame) -> DataFrame:
    """page, seq, covers, share: spans of which something painted later covers 0.6 of the area or more."""
    rows = _pairs(spans, paint).where("c_seq > t_seq").withColumn("share", geometry.coverage("t_", "c_"))
    return rows.where(F.col("share") >= COVERED).groupBy("page", F.col("t_seq").alias("seq")).agg(F.count(F.lit(1)).alias("covers"), F.max("share").alias("share"))


def backgrounds(spans: DataFrame, paint: DataFrame) -> DataFrame:
    """page, seq, behind, same_color: the latest thing painted before a span that holds all of it."""
    rows = _pairs(spans, paint).where("c_seq < t_seq").where(geometry.inside("t_", "c_"))
    last = rows.groupBy("page", F.col("t_seq").alias("seq")).agg(F.max("c_seq").alias("behind"), F.max_by(F.abs(F.col("t_channel") - F.col("c_channel")) <= 0.03, "c_seq").alias("same_color"))
    return last


def struck_words(spans: DataFrame, strikes: DataFrame, paint: DataFrame) -> DataFrame:
    """page, stroke, seq: strikes (page, seq, x0, y0, x1, y1) bound to the only span that they cross over more than half
    of its width, where nothing painted later covers that span."""
    w = spans.select("page", *[F.col(x).alias(f"t_{x}") for x in ("seq", "x0", "y0", "x1", "y1")])
    s = strikes.select("page", *[F.col(x).alias(f"s_{x}") for x in ("seq", "x0", "y0", "x1", "y1")])
    y = (F.col("s_y0") + F.col("s_y1")) / 2
    width = F.least("t_x1", "s_x1") - F.greatest("t_x0", "s_x0")
    hits = w.join(s, "page").where((y > F.col("t_y0")) & (y < F.col("t_y1")) & (width > (F.col("t_x1") - F.col("t_x0")) * 0.5))
    one = hits.groupBy("page", "s_seq").agg(F.count(F.lit(1)).alias("n"), F.min("t_seq").alias("seq")).where("n = 1")
    return one.join(covered(spans, paint).select("page", "seq"), ["page", "seq"], "left_anti").select("page", F.col("s_seq").alias("stroke"), "seq")
