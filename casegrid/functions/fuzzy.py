"""Similarity of short texts to closed lists, on a scale of 100, as Columns that stay in the JVM.

The common subsequence is counted a row of bits at a time: a list's text gives each character the mask of its places,
and folding the masks of a read's characters leaves a bit for each character of the common subsequence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folded(masks: Column) -> Column:
    def step(row: Column, mask: Column) -> Column:
        both = row.bitwiseOR(mask)
        return both.bitwiseAND(F.bitwise_not(both - F.shiftleft(row, 1).bitwiseOR(F.lit(1).cast("long"))))

    return F.bit_count(F.aggregate(masks, F.lit(0).cast("long"), step))


def _masks(value: Column, choice: str) -> Column:
    """For each character of a read, the bits of its places in a text of the list, which has 62 characters at most."""
    if not 0 < len(choice) <= 62:
        raise ValueError("1 to 62 characters")
    places: dict[str, int] = {}
    for i, c in enumerate(choice):
        places[c] = places.get(c, 0) | 1 << i
    known = F.create_map(*[x for c, m in places.items() for x in (F.lit(c), F.lit(m).cast("long"))])
    return F.transform(F.split(value, ""), lambda c: F.coalesce(F.try_element_at(known, c), F.lit(0).cast("long")))


def common(value: Column, choice: str) -> Column:
    """Length of the longest common subsequence of a read and a text of the list."""
    return _folded(_masks(value, choice)) if choice else F.lit(0)


def ratio(value: Column, choice: str) -> Column:
    """Twice the common subsequence over both lengths; 100 for two empty texts."""
    both = F.length(value) + len(choice)
    return F.when(both == 0, 100.0).otherwise(F.lit(200.0) * common(value, choice) / both)


def partial(value: Column, choice: str) -> Column:
    """The best ratio of the list's text with a window of its length in a longer read, or of a shorter read with a window
    of the text."""
    n, size = len(choice), F.length(value)
    over = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: ratio(F.substr(value, i, F.lit(n)), choice))
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.least(size, F.lit(n))) - 1  # as many bits as the read is long
    inside = lambda i: F.transform(_masks(value, choice), lambda m: F.call_function("shiftright", m, i).bitwiseAND(low))
    under = F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), lambda i: F.lit(100.0) * _folded(inside(i)) / size)
    return F.when(size == 0, 0.0).when(size >= n, F.array_max(over)).otherwise(F.array_max(under))


def ranked(value: Column, choices: list[str], score=ratio) -> Column:
    """struct(best, score, margin): the most similar text of a list (the first at ties) and its lead over the next."""
    rows = F.array(*[F.struct((-score(value, c)).alias("low"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(choices)])
    top = F.slice(F.array_sort(rows), 1, 2)
    best, runner = F.element_at(top, 1), F.try_element_at(top, F.lit(2))
    return F.struct(best["c"].alias("best"), (-best["low"]).alias("score"), (F.coalesce(runner["low"], F.lit(0.0)) - best["low"]).alias("margin"))


def snapped(value: Column, choices: list[str], least: float) -> Column:
    """struct(best, score, margin) of ``ranked``; best is null under the least score, and all is null for an empty read."""
    r = ranked(value, choices)
    return F.when(value != "", F.struct(F.when(r["score"] >= least, r["best"]).alias("best"), r["score"].alias("score"), F.when(r["score"] >= least, r["margin"]).otherwise(0.0).alias("margin")))
