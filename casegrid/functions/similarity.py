"""Similarity of short texts on a scale of 100: edit ratios as Columns, and richer ones as pandas functions."""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterator


import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def edit_ratio(a: Column, b: Column) -> Column:
    """100 for equal texts, less by each edit of the longer one."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise((1 - F.levenshtein(a, b) / longest) * 100)


def snap(value: Column, choices: list[str], ratio=edit_ratio) -> Column:
    """struct(best, score, margin): the most similar of a closed list (the first at ties) and its lead over the next
    one. The list is a literal, so nothing is joined."""
    scored = F.array(*[F.struct((-ratio(value, F.lit(c))).alias("low"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(choices)])
    ranked = F.slice(F.array_sort(scored), 1, 2)
    best = F.element_at(ranked, 1)
    return F.struct(best["c"].alias("best"), (-best["low"]).alias("score"), (F.coalesce(F.try_element_at(ranked, F.lit(2))["low"], F.lit(0.0)) - best["low"]).alias("margin"))


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = 0
    for c in b:
        both = row | places.get(c, 0)
        row = both & ~(both - (row << 1 | 1))
    return row.bit_count()


def indel(a: str, b: str) -> float:
    """100 times twice the common subsequence over both lengths."""
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def partial(a: str, b: str) -> float:
    """The best indel ratio of the shorter text with a window of its length in the longer."""
    short, long = sorted((a, b), key=len)
    n = len(short)
    return 100.0 if not n else max(indel(short, long[i : i + n]) for i in range(len(long) - n + 1))


def token_set(a: str, b: str) -> float:
    """Indel ratio over distinct sorted words, the shared ones held against each side."""
    x, y = set(a.split()), set(b.split())
    shared = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, (shared, " ".join(sorted(s))))) for s in (x - y, y - x))
    return max(indel(shared, left) if shared else 0.0, indel(shared, right) if shared else 0.0, indel(left, right))


def weighted_edit(read: str, legal: str, pairs: dict[tuple[str, str], float], drop: dict[str, float], add: dict[str, float], case_only: float = 0.3) -> float:
    """Similarity of a read to a legal value under the costs of reading one character as another, of dropping and of
    adding one; a change of case alone is cheap. Row by row, the usual dynamic programme."""
    row = np.concatenate(([0.0], np.cumsum([add.get(c, 1.0) for c in read])))
    for c in legal:
        old, gone = row, drop.get(c, 1.0)
        row = np.empty_like(old)
        row[0] = old[0] + gone
        for j, d in enumerate(read, 1):
            swap = 0.0 if c == d else case_only if c.lower() == d.lower() else pairs.get((c, d), 1.0)
            row[j] = min(old[j] + gone, row[j - 1] + add.get(d, 1.0), old[j - 1] + swap)
    return max(0.0, 100.0 * (1 - row[-1] / max(len(read), len(legal), 1)))


def _pairwise(function):
    @F.pandas_udf(T.DoubleType())
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple[str, str], float] = {}
        for a, b in parts:
            out = []
            for x, y in zip(a, b, strict=True):
                if x is None or y is None:
                    out.append(None)
                    continue
                if (x, y) not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[x, y] = function(x, y)
                out.append(known[x, y])
            yield pd.Series(out, dtype="float64")

    return run


indel_ratio, partial_ratio, token_set_ratio = _pairwise(indel), _pairwise(partial), _pairwise(token_set)
sequence_ratio = _pairwise(lambda a, b: difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() * 100)

KNOWN = 100_000


def by_distinct(function: Callable[[str], object], result: T.DataType, letters: str | None = None):
    """An Arrow function of one text, worked out once for each distinct text of a batch and kept for later ones (KNOWN of
    them at most), so that rows neither leave their task nor meet a table of distinct texts. With ``letters`` all others
    are read as one, where ``function`` doesn't tell them apart."""
    other = None if letters is None else f"[^{''.join(map(re.escape, sorted(set(letters))))}]"
    kind = to_arrow_type(result)

    @F.arrow_udf(result)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str | None, object] = {None: None}
        for texts in parts:
            coded = texts.dictionary_encode(null_encoding="encode")
            alike = coded.dictionary if other is None else pc.replace_substring_regex(coded.dictionary, other, "\0")
            alike = alike.dictionary_encode(null_encoding="encode")
            each = alike.dictionary.to_pylist()
            if len(known) > KNOWN:
                known = {None: None}
            for x in each:
                if x not in known:
                    known[x] = function(x)
            yield pa.array([known[x] for x in each], kind).take(alike.indices).take(coded.indices)

    return run


def partial_at_least(choice: str, least: float):
    """Whether the partial ratio of a text with one of a closed list reaches a bound; that of an empty text is 0."""
    return by_distinct(lambda x: bool(x) and partial(x, choice) >= least, T.BooleanType(), choice)


def indel_snapped(choices: list[str]):
    """struct(i, score) of a text: the number of the most similar text of a closed list, the first at ties."""
    def best(x: str) -> dict:
        scores = [indel(x, c) for c in choices]
        return {"i": int(np.argmax(scores)), "score": max(scores)}

    return by_distinct(best, T.StructType.fromDDL("i int, score double"))
