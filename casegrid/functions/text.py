"""Scalar functions over evidence text, as Columns that stay in the JVM."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

NONE_SPELLINGS = ["none", "n/a", "nil", ""]
# Stamps of copies that no longer count.
CANCEL_STAMPS = ["ARCHIVE", "FILED", "COPY", "DUPLICATE", "VOID", "SUPERSEDED", "SUPERSED", "CANCELLED", "CANCELED", "DRAFT", "REISSUED", "REPLACED", "EXPIRED", "SPECIMEN"]
# Page titles in dictionary order.
TITLES = [("note", "ADJUDICATOR NOTE"), ("intake", "INTAKE FORM"), ("fee_receipt", "FEE RECEIPT"), ("biometric", "BIOMETRIC SLIP"), ("sponsor_letter", "SPONSOR LETTER"), ("registry", "REGISTRY EXTRACT")]
# Code points that show nothing, and letters that look like Latin ones.
INVISIBLE = "[\\u200b-\\u200f\\u2028-\\u202e\\u2060-\\u2064\\u00ad\\ufeff\\x{e0000}-\\x{e007f}]"
LOOKALIKES = ("АВЕКМНОРСТХаеорсухІіЅѕЈјΑΒΕΖΗΙΚΜΝΟΡΤΥΧοε", "ABEKMHOPCTXaeopcyxIiSsJjABEZHIKMNOPTYXoe")


def compact(s: Column) -> Column:
    """Lower case without white space and dots."""
    return F.lower(F.regexp_replace(s, r"[\s.]+", ""))


def folded(s: Column) -> Column:
    """Case and white space folded, for comparing values."""
    return F.lower(F.trim(F.regexp_replace(s, r"\s+", " ")))


def sanitized(s: Column) -> Column:
    """Without invisible code points, look-alike letters folded to ASCII. ASCII texts stay as they are; compatibility
    normalization, which has no JVM built-in, is the pandas function ``nfkc``."""
    return F.when(s.rlike(r"^\p{ASCII}*$"), s).otherwise(F.translate(F.regexp_replace(s, INVISIBLE, ""), *LOOKALIKES))


def nfkc(s: Column) -> Column:
    """Unicode NFKC, in Arrow batches; only texts beyond ASCII pay for it."""

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))

    return run(s)


def tokens(s: Column) -> Column:
    """Lexical tokens: letters and digits, joined by hyphen, underscore or bar; lower case."""
    return F.transform(F.regexp_extract_all(sanitized(s), F.lit(r"[A-Za-z0-9]+(?:[-_|][A-Za-z0-9]+)*"), F.lit(0)), F.lower)


def sponsor_repaired(s: Column) -> Column:
    """The first sponsor id after dropping spaces, raising case, O read as 0 and a stop read as hyphen; null without one."""
    x = F.regexp_replace(F.translate(F.upper(F.regexp_replace(s, r"\s+", "")), "O", "0"), r"SPN\.", "SPN-")
    found = F.regexp_extract(x, r"SPN-\d{4}", 0)
    return F.when(found != "", found)


def real_date(s: Column) -> Column:
    """The ISO date, null unless it is written in full and on the calendar."""
    return F.when(s.rlike(vocab.ISO_DATE), F.try_to_date(s, "yyyy-MM-dd"))


def date_repaired(s: Column) -> Column:
    """struct(value, score): a strict ISO date scores 90; year, separators and one or two digits each, 80; null otherwise."""
    strict = F.regexp_extract(s, r"\d{4}-\d{2}-\d{2}", 0)
    part = lambda k: F.regexp_extract(s, r"(\d{4})[-/. ]+(\d{1,2})[-/. ]+(\d{1,2})", k)
    loose = F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))
    row = lambda v, n: F.struct(v.alias("value"), F.lit(n).alias("score"))
    return F.when(real_date(strict).isNotNull(), row(strict, 90)).when((part(1) != "") & real_date(loose).isNotNull(), row(loose, 80))


def flag_set(s: Column) -> Column:
    """The set behind a bar-joined value; ``none`` and the empty text are the empty set. Sorted and distinct."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(s, F.lit("none")), r"\|"), lambda x: ~x.isin("none", ""))))


def flag_text(flags: Column) -> Column:
    """The canonical text of a flag set."""
    return F.when(F.size(flags) == 0, F.lit("none")).otherwise(F.array_join(F.array_sort(F.array_distinct(flags)), "|"))


def flags_parsed(s: Column) -> Column:
    """struct(value, score) of a list of flags: known ones 90, a spelling of none 90, content without a known flag none at 40."""
    parts = F.transform(F.split(F.lower(s), r"[|,;]+"), lambda x: F.trim(x))
    known = F.filter(parts, lambda x: x.isin(vocab.FLAGS))
    content = F.exists(parts, lambda x: ~x.isin(NONE_SPELLINGS))
    score = F.when(F.size(known) > 0, 90).when(content, 40).otherwise(90)
    return F.struct(flag_text(known).alias("value"), score.alias("score"))


def labelled(s: Column, label: str) -> Column:
    """What follows a label and its separator at the start of a line; null if the line has another label."""
    pattern = rf"(?i)^\s*{label}\s*[:\-]?\s*(.*?)\s*$"
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, 1))


CORRECTION = r"(?i)^manual correction:\s*([a-z ]+?)\s*->\s*(.*?)\s*$"


def correction(s: Column) -> Column:
    """struct(field, value) of a manual correction; alternatives after a slash and negated values are rejected."""
    field = F.regexp_replace(F.lower(F.regexp_extract(s, CORRECTION, 1)), " ", "_")
    value = F.regexp_extract(s, CORRECTION, 2)
    good = s.rlike(CORRECTION) & field.isin(vocab.FIELDS) & ~value.contains("/") & (value != "") & ~negates(value)
    return F.when(good, F.struct(field.alias("field"), value.alias("value")))


def negates(raw: Column, canonical: Column | None = None) -> Column:
    """Whether a text negates a value: its first word is no, not or never, or it is the value behind a negating prefix."""
    words = F.regexp_extract_all(F.lower(raw), F.lit("[a-z0-9]+"), F.lit(0))
    first = F.coalesce(F.try_element_at(words, F.lit(1)).isin("no", "not", "never"), F.lit(False))
    if canonical is None:
        return first
    plain = F.array_join(F.regexp_extract_all(F.lower(canonical), F.lit("[a-z0-9]+"), F.lit(0)), "")
    joined = F.array_join(words, "")
    return first | reduce(lambda a, b: a | b, [joined == F.concat(F.lit(p), plain) for p in ("no", "not", "never", "un", "non", "dis")])


def finding(s: Column) -> Column:
    """The finding of a line: labelled (null value if it isn't one), or a bare upper-case one. struct(labelled, value)."""
    given = F.regexp_replace(F.upper(F.regexp_extract(s, r"(?i)^finding\s*:\s*(.*?)\s*$", 1)), " ", "_")
    verdicts = ["APPROVED", "DENIED", "NEEDS_REVIEW"]
    return (
        F.when(s.rlike(r"(?i)^finding\s*:"), F.struct(F.lit(True).alias("labelled"), F.when(given.isin(verdicts), given).alias("value")))
        .when(s.isin("APPROVED", "DENIED", "NEEDS REVIEW"), F.struct(F.lit(False).alias("labelled"), F.regexp_replace(s, " ", "_").alias("value")))
    )


def is_watermark(s: Column) -> Column:
    return s.rlike(r"(?i)\b(sample|answer\s*key|specimen|training copy)\b")


def cancel_stamps(s: Column) -> Column:
    """The cancellation stamps that a text holds, in their listed order."""
    return F.array_compact(F.array(*[F.when(F.contains(F.upper(s), F.lit(x)), F.lit(x)) for x in CANCEL_STAMPS]))


def holds_stamp(upper: Column) -> Column:
    """Whether an upper-case text holds a cancellation stamp."""
    return reduce(lambda a, b: a | b, [F.contains(upper, F.lit(x)) for x in CANCEL_STAMPS])


def paid_amount(s: Column) -> Column:
    """Whether a line states a paid amount, with no letter or digit directly around it."""
    return s.rlike(r"(?i)(?<![A-Za-z0-9])amount\s+paid:?\s*\$?\d+(\.\d\d)?(?![A-Za-z0-9])")


def letter(s: Column) -> Column:
    """struct(name, world, visa) of a letter's sentence."""
    part = lambda k: F.regexp_extract(s, r"^The applicant (\w+ \w+) of (.+) requests a ([A-Z]+-\d) visa\.$", k)
    return F.when(part(1) != "", F.struct(part(1).alias("name"), part(2).alias("world"), part(3).alias("visa")))


def pdf_date(s: Column) -> Column:
    """The day of a document date such as D:20260629..."""
    return F.try_to_date(F.regexp_extract(s, r"^D:(\d{8})", 1), "yyyyMMdd")


def digits_read(s: Column) -> Column:
    """Letters that stand for digits in bad reads."""
    return F.translate(s, "OLIB", "0118")


def hamming(a: Column, b: Column) -> Column:
    """Differing characters of texts of equal length; null otherwise."""
    return F.when(F.length(a) == F.length(b), F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda x: x)))


def md5_modulo(s: Column, n: int) -> Column:
    """The text's MD5, as a number, modulo 5 or 2: 16 is 1 modulo 5, so the sum of the hex digits does, and its last
    digit has the parity."""
    digest = F.md5(s.cast("binary"))
    if n == 5:
        return F.aggregate(F.split(digest, ""), F.lit(0), lambda a, c: a + F.instr(F.lit("0123456789abcdef"), c) - 1) % 5
    if n == 2:
        return (F.instr(F.lit("0123456789abcdef"), F.right(digest, F.lit(1))) - 1) % 2
    raise ValueError("5 or 2")


def error_tail(s: Column, most: int = 400) -> Column:
    """The class and the last line that isn't empty, the end of it if it is long."""
    lines = F.filter(F.split(s, "\n"), lambda x: F.trim(x) != "")
    return F.right(F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit("")), F.lit(most))


def failure_category(s: Column) -> Column:
    return F.when(F.contains(s, F.lit("Timeout")), "timeout").when(F.contains(s, F.lit("session")), "session").when(F.contains(s, F.lit("Memory")), "memory").otherwise("other")


def path_key(decision: Column, reasons: Column, n_read: Column) -> Column:
    """decision:first reason up to its colon:fields read, nine at most."""
    first = F.split_part(F.coalesce(F.try_element_at(reasons, F.lit(1)), F.lit("")), F.lit(":"), F.lit(1))
    return F.concat_ws(":", decision, first, F.least(n_read, F.lit(9)).cast("string"))


def answer_key(s: Column) -> Column:
    """struct(cells, verdict) of a line of eleven comma cells."""
    cells = F.transform(F.split(s, ","), lambda x: F.trim(x))
    return F.when(F.size(cells) == 11, F.struct(cells.alias("cells"), F.try_element_at(cells, F.lit(11)).alias("verdict")))


def number(s: Column, default: float) -> Column:
    """A finite number or the default."""
    x = s.try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(default)).otherwise(x)
