"""Rectangles and colours on a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def overlap(a: str, b: str) -> Column:
    """Area shared by two rectangles whose sides are the columns x0, y0, x1, y1 under two prefixes."""
    c = F.col
    return area(F.greatest(c(f"{a}x0"), c(f"{b}x0")), F.greatest(c(f"{a}y0"), c(f"{b}y0")), F.least(c(f"{a}x1"), c(f"{b}x1")), F.least(c(f"{a}y1"), c(f"{b}y1")))


def coverage(a: str, b: str) -> Column:
    """Share of rectangle a that b covers; 0 for an empty a."""
    own = area(*(F.col(f"{a}{s}") for s in ("x0", "y0", "x1", "y1")))
    return F.when(own > 0, overlap(a, b) / own).otherwise(0.0)


def inside(a: str, b: str, tolerance: float = 1e-3) -> Column:
    c = F.col
    return (c(f"{a}x0") >= c(f"{b}x0") - tolerance) & (c(f"{a}y0") >= c(f"{b}y0") - tolerance) & (c(f"{a}x1") <= c(f"{b}x1") + tolerance) & (c(f"{a}y1") <= c(f"{b}y1") + tolerance)


def rgb(color: Column) -> Column:
    """Red, green and blue of a gray, RGB or CMYK colour; null for others."""
    at = lambda i: F.try_element_at(color, F.lit(i))
    return (
        F.when(F.size(color) == 1, F.array(at(1), at(1), at(1)))
        .when(F.size(color) == 3, color)
        .when(F.size(color) == 4, F.array(*[(1 - at(i)) * (1 - at(4)) for i in (1, 2, 3)]))
    )


def dashes(pattern: Column) -> Column:
    """The numbers of a dash pattern such as [3 2] 0."""
    return F.transform(F.regexp_extract_all(F.regexp_extract(pattern, r"\[([^\]]*)\]", 1), F.lit(r"[0-9.]+"), F.lit(0)), lambda x: x.try_cast("double"))
