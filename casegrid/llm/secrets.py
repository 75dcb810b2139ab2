"""Secret scans in SQL alone: exact patterns, and a battery of randomness tests that adds spans.

Positions come without any UDF: splitting a text by a pattern gives the pieces between its matches, extracting gives
the matches, and running sums of their lengths are the spans, in code points.

The battery reads maximal runs of letters, digits and ``+/_-`` of 20 characters or more. A token's encoding is inferred
from its characters (hexadecimal, base 32, base 36, letters alone, base 64; ``-`` and ``_`` between characters of the
smaller alphabets count as separators). All-digit tokens, and lower-case ones with ``+`` or ``/`` as paths have, are of
none and are not tested. Three tests are made in the encoding's alphabet: chi-squared uniformity, the number of runs
about the alphabet's cut, and lag-one serial correlation. Each is asked two questions. Could the token be random? None
of the three may speak against it. Could it be ordinary writing? The three statistics are held against what they are in
words and identifiers, and Stouffer's method combines them to one p-value, which falls with length.
Benjamini-Hochberg, in each class of length by itself, bounds the share of ordinary tokens among those reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex")
#: The added spans' kind.
MORE = "random"
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
RUN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+"
SHORTEST, FALSE_SHARE, LEAST_P = 20, 0.001, 0.001
BINS_PER_UNIT, MOST_BIN = 20, 600
LOWER, UPPER, DIGITS, VOWELS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "aeiou"
CONSONANTS = "".join(c for c in LOWER if c not in VOWELS)
#: Ordinary writing: chance of equal characters in a pair, and the sum of cubed letter shares, whose excess over the square of that chance spreads it.
SAME_PAIR, CUBES = 0.065, 0.0052
#: Encodings in the order in which they are tried: pattern of the token, its alphabet in two parts with the cut between,
#: what ordinary writing has of it (changes of part from one character to the next, serial correlation), and whether
#: random tokens have more changes than that (and less correlation) or fewer (and more).
ENCODINGS = [
    ("^[0-9-_]*=*$", None, None, 0, 0, 0),
    ("^[0-9a-f_-]*[0-9][0-9a-f_-]*$", DIGITS, "abcdef", 0.15, 0.3, 1),
    ("^[0-9A-F_-]*[0-9][0-9A-F_-]*$", DIGITS, "ABCDEF", 0.15, 0.3, 1),
    ("^[A-Z_-]+=*$", VOWELS.upper(), CONSONANTS.upper(), 0.6, -0.25, -1),
    ("^[a-z_-]+=*$", VOWELS, CONSONANTS, 0.6, -0.25, -1),
    ("^[A-Z2-7_-]+=*$", "234567", UPPER, 0.15, 0.3, 1),
    ("^[a-z2-7_-]+=*$", "234567", LOWER, 0.15, 0.3, 1),
    ("^[A-Z0-9_-]+=*$", DIGITS, UPPER, 0.15, 0.3, 1),
    ("^[a-z0-9_-]+=*$", DIGITS, LOWER, 0.15, 0.3, 1),
    ("^[A-Za-z_-]+=*$", LOWER, UPPER, 0.3, 0.3, 1),
    ("[A-Z].*[a-z]|[a-z].*[A-Z]", LOWER, UPPER + DIGITS + "+/", 0.3, 0.3, 1),
]


def quoted(pattern: str) -> str:
    """The pattern as a raw SQL string literal."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def spans(pattern: str, group: int | None = None) -> str:
    """SQL for the matches of a pattern in t: array of (s, e, x), x the given group (by default the whole match)."""
    p = quoted(pattern)
    whole = f"regexp_extract_all(t, {p}, 0)"
    shown = whole if group is None else f"regexp_extract_all(t, {p}, {group})"
    none = "cast(array() as array<struct<s: bigint, e: bigint, x: string>>)"
    step = """named_struct('at', a.at + length(m.p) + length(m.w),
        'out', concat(a.out, array(named_struct('s', a.at + length(m.p), 'e', a.at + length(m.p) + length(m.w), 'x', m.x))))"""
    rows = f"zip_with({whole}, zip_with(slice(split(t, {p}, -1), 1, size({whole})), {shown}, (p, x) -> named_struct('p', p, 'x', x)), (w, r) -> named_struct('w', w, 'p', r.p, 'x', r.x))"
    return f"if(t rlike {p}, aggregate({rows}, named_struct('at', 0L, 'out', {none}), (a, m) -> {step}, a -> a.out), {none})"


def encoding(x: str) -> str:
    """SQL for the encoding of a token: its alphabet, the part of each of its characters, and ordinary writing's figures."""
    when = []
    for pattern, first, second, change, serial, sign in ENCODINGS:
        made = "null" if first is None else f"named_struct('a', '{first + second}', 'p', '{'a' * len(first) + 'b' * len(second)}', 'c', {change}D, 's', {serial}D, 'w', {sign}D)"
        when.append(f"when {x} rlike {quoted(pattern)} then {made}")
    return f"case {' '.join(when)} end"


def battery() -> str:
    """SQL for one token c of (s, e, x): its class of length and the bin of its p-value; null if it isn't tested or
    can't be random."""
    full = f"length(y.enc.a) = {len(LOWER + UPPER + DIGITS) + 2}"  # base 64 has signs of its own; elsewhere they separate
    read = f"named_struct('enc', {encoding('c.x')}, 'x', rtrim('=', c.x), 's', c.s, 'e', c.e)"
    body = f"named_struct('enc', y.enc, 'x', if({full}, translate(y.x, '-_', '+/'), translate(y.x, '-_', '')), 's', y.s, 'e', y.e)"
    # y has the token's characters x; z their number n, squares q of each one's count, cut parts t and places v
    squares = "aggregate(transform(array_distinct(split(y.x, '')), ch -> length(y.x) - length(replace(y.x, ch, ''))), 0D, (a, n) -> a + n * n)"
    places = "transform(split(y.x, ''), ch -> cast(locate(ch, y.enc.a) as double))"
    measured = f"named_struct('enc', y.enc, 'k', cast(length(y.enc.a) as double), 'n', cast(length(y.x) as double), 'q', {squares}, 't', translate(y.x, y.enc.a, y.enc.p), 'v', {places}, 's', y.s, 'e', y.e)"
    # w adds the mean place m, the number h of characters before the cut and the number r of runs
    series = r"named_struct('enc', z.enc, 'k', z.k, 'n', z.n, 'q', z.q, 'v', z.v, 'm', aggregate(z.v, 0D, (a, b) -> a + b) / z.n, 'h', cast(length(replace(z.t, 'b', '')) as double), 'r', cast(length(regexp_replace(z.t, r'(.)\1+', '$1')) as double), 's', z.s, 'e', z.e)"
    spread = "aggregate(w.v, 0D, (a, b) -> a + (b - w.m) * (b - w.m))"
    lag = "aggregate(zip_with(slice(w.v, 1, int(w.n) - 1), slice(w.v, 2, int(w.n) - 1), (a, b) -> (a - w.m) * (b - w.m)), 0D, (a, b) -> a + b)"
    serial = f"({lag} / greatest({spread}, 1e-9D))"
    # random: chi-squared by Wilson and Hilferty, runs by Wald and Wolfowitz
    chi = "(w.k * w.q / w.n - w.n)"
    chi_z = f"((power(greatest({chi}, 0D) / (w.k - 1), 1D / 3) - (1 - 2D / (9 * (w.k - 1)))) / sqrt(2D / (9 * (w.k - 1))))"
    expect = "(1 + 2 * w.h * (w.n - w.h) / w.n)"
    runs_z = f"(abs(w.r - {expect}) / sqrt(greatest(({expect} - 1) * ({expect} - 2) / (w.n - 1), 1e-9D)))"
    # ordinary: chi-squared grows with the number of equal pairs, which has a mean and a spread in writing; so have the runs
    equal, mean = "((w.q - w.n) / 2)", f"(w.n * (w.n - 1) / 2 * {SAME_PAIR}D)"
    chi_text = f"(({mean} - {equal}) / sqrt({mean} * {1 - SAME_PAIR}D + w.n * (w.n - 1) * (w.n - 2) * {CUBES - SAME_PAIR**2}D))"
    runs_text = "(w.enc.w * (w.r - 1 - w.enc.c * (w.n - 1)) / sqrt(w.enc.c * (1 - w.enc.c) * (w.n - 1)))"
    serial_text = "(w.enc.w * (w.enc.s - w.serial) * sqrt(w.n))"
    correlated = f"named_struct('enc', w.enc, 'k', w.k, 'n', w.n, 'q', w.q, 'h', w.h, 'r', w.r, 'serial', {serial}, 's', w.s, 'e', w.e)"
    tested = f"named_struct('s', w.s, 'e', w.e, 'n', w.n, 'chi', {chi_z}, 'runs', {runs_z}, 'serial', abs(w.serial) * sqrt(w.n), 'text', ({chi_text} + {runs_text} + {serial_text}) / sqrt(3D))"
    out = f"transform(filter(found, c -> length(c.x) >= {SHORTEST}), c -> {read})"
    out = f"transform(filter({out}, y -> y.enc is not null), y -> {body})"
    out = f"filter({out}, y -> length(y.x) >= {SHORTEST})"
    for made, name in ((measured, "y"), (series, "z"), (correlated, "w"), (tested, "w")):
        out = f"transform({out}, {name} -> {made})"
    tail = lambda z: f"if({z} >= 0, 0.5D * exp(-0.717D * {z} - 0.416D * {z} * {z}), 1 - 0.5D * exp(0.717D * {z} - 0.416D * {z} * {z}))"
    out = f"filter({out}, u -> {tail('u.chi')} >= {LEAST_P}D and 2 * {tail('u.runs')} >= {LEAST_P}D and 2 * {tail('u.serial')} >= {LEAST_P}D)"
    # the exponent of the tail approximation is taken as it stands, so that very small p-values keep their order
    minus_log = "if(u.text >= 0, (0.6931D + 0.717D * u.text + 0.416D * u.text * u.text) / 2.302585D, 0D)"
    return f"transform({out}, u -> named_struct('s', u.s, 'e', u.e, 'class', int(least(floor(log2(u.n)), 16)), 'bin', int(least(floor({minus_log} * {BINS_PER_UNIT}), {MOST_BIN}))))"


def scanned(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """docs' columns ``keep`` with n_assign, n_access, n_hex, base_sha256 and spans.

    A null or empty text has no spans: counts 0, the digest of the empty string and an empty string. Whole texts are
    read; clashing columns give way; repeated rows give equal results.
    """
    common.prepare(docs.sparkSession)
    new = {"n_assign", "n_access", "n_hex", "base_sha256", "spans"}
    held = [c for c in keep if c not in new]
    own = docs.select(F.struct(*held).alias("kept"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    flat = "transform({}, m -> named_struct('s', m.s, 'o', {}, 'e', m.e))"
    assign = f"filter({spans(ASSIGN, 2)}, m -> length(m.x) >= 6)"
    base = f"array_sort(concat({flat.format(assign, 0)}, {flat.format(spans(ACCESS), 1)}, {flat.format(spans(HEX), 2)}))"
    known = own.select("kept", F.expr(base).alias("base"), F.expr(f"filter({spans(RUN)}, c -> length(c.x) >= {SHORTEST})").alias("found"))
    known = known.select("kept", "base", F.expr("filter(found, c -> not exists(base, b -> b.s < c.e and c.s < b.e))").alias("found"))
    known = known.select("kept", "base", F.expr(f"if(size(found) > 0, {battery()}, null)").alias("tested")).checkpoint()
    family = known.select(F.explode("tested").alias("u")).groupBy("u.class", "u.bin").agg(F.count(F.lit(1)).alias("n"))
    ranked = family.select("class", "bin", F.expr("sum(n) over (partition by class order by bin desc)").alias("rank"), F.expr("sum(n) over (partition by class)").alias("m"))
    passed = ranked.where(f"bin / {BINS_PER_UNIT}D >= -log10({FALSE_SHARE}D * rank / m)").groupBy("class").agg(F.min("bin").alias("least"))
    cut = {r["class"]: r["least"] for r in passed.collect()}  # at most 13 rows: one for each power of two
    chosen = " or ".join(f"(u.class = {k} and u.bin >= {v})" for k, v in sorted(cut.items())) or "false"
    names = "case b.o when 0 then 'assign' when 1 then 'access' when 2 then 'hex' else 'random' end"
    written = "array_join(transform({}, b -> concat(" + names + ", ':', b.s, ':', b.e)), ',')"
    extra = f"transform(filter(coalesce(tested, array()), u -> {chosen}), u -> named_struct('s', u.s, 'o', 3, 'e', u.e))"
    counts = [F.expr(f"cast(size(filter(base, b -> b.o = {o})) as bigint)").alias(f"n_{k}") for o, k in enumerate(KINDS)]
    return known.select(*[F.col(f"kept.`{c}`").alias(c) for c in held], *counts, F.sha2(F.expr(written.format("base")).cast("binary"), 256).alias("base_sha256"), F.expr(written.format(f"array_sort(concat(base, {extra}))")).alias("spans"))
