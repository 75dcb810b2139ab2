"""The grammar of damaged reads: what a line is, which legal value a read stands for, and when it stands for none.

A similarity to a closed list is worked out once for each distinct read and joined back, as reads repeat far more often
than they differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import fuzzy as Z
from ..functions import similarity as S
from ..functions import text as X
from ..sources.materialize import importable, materialized

# Lines that say nothing, marks of deliberate damage, the footer of a packet's page.
NOISE = ["passportimage", "registryimage", "scanimage", "scantab", "copyartifact", "copy", "intake", "archive", "filed", "clear", "mib", "primaryintakerecord", "mibeyesonly"]
DAMAGE = r"(?i)(washed\s*out|unreadable|cut\s*out|blank|redacted|missing|torn|whiteout|white\s*out|obscured|illegible|lost)\s*\]?\s*$"
FOOTER = r"(?i)packet\s*MIB[\s-]*\d{6}\s*/?\s*page"
# Labels, what they announce, and the least similarity at which a label line is theirs.
LABELS = [("applicant", "applicant_name"), ("registryname", "applicant_name"), ("speciescode", "species_code"), ("speciesmatch", "species_code"), ("homeworld", "home_world"), ("homeplanet", "home_world"), ("visaclass", "visa_class"), ("visatype", "visa_class"), ("sponsorid", "sponsor_id"), ("arrivaldate", "arrival_date"), ("declaredpurpose", "declared_purpose"), ("purpose", "declared_purpose"), ("observedflags", "risk_flags"), ("riskflags", "risk_flags"), ("flagsobserved", "risk_flags"), ("feestatus", "fee_status")]
LABEL_LEAST, NOTE_LEAST, ENUM_LEAST, EMBARGO_LEAST, FLAG_LEAST = 78, 70, 72, 90, 78
# The header of a note; words of labels that run into a name; the heads of an embargo line.
NOTE_HEADER = "manual adjudicator note"
NAME_LABELS = ["applicant", "registry", "name"]
EMBARGO_STATUS, EMBARGO_HEAD = r"(?i)embargo\s*rev|mbargorev|bargorev", r"(?i)^\W*(emb|bargo|rgorev)"
VOCABULARIES = {"species_code": vocab.SPECIES, "home_world": vocab.WORLDS, "visa_class": vocab.VISAS, "declared_purpose": vocab.PURPOSES}


def once(rows: DataFrame, read: str, steps: list[dict[str, Column]]) -> DataFrame:
    """rows with the columns of the last step, which depend on one read alone, worked out for its distinct values. A step
    may use the columns of those before it, which are then not worked out anew wherever they are used. What is found for
    the distinct reads is written once: a filter on it would otherwise be moved below the steps, and repeat them. Null
    reads get null columns."""
    distinct, held = rows.select(read).where(F.col(read).isNotNull()).distinct(), [read]
    for columns in steps:
        distinct = distinct.select(*held, *[c.alias(k) for k, c in columns.items()])
        held = [*held, *columns]
    return rows.join(materialized(distinct.select(read, *steps[-1])), read, "left")


def plain(s: Column) -> Column:
    """A read without the marks that surround a value."""
    return F.regexp_replace(s, r"^[ .:|]+|[ .:|]+$", "")


def line_kind(s: Column) -> Column:
    """footer, noise, damage or text."""
    return F.when(s.rlike(FOOTER), "footer").when(X.compact(s).isin(NOISE), "noise").when(s.rlike(DAMAGE), "damage").otherwise("text")


def note_signals(lines: DataFrame) -> DataFrame:
    """case_id, page, signals, note_like: the signs of a note among a page's lines, sorted. A page whose type isn't known
    takes two of them to be one."""
    importable(lines.sparkSession)
    s = F.trim("text")
    signs = {"finding": s.rlike(r"(?i)^\W{0,4}finding\W"), "header": S.partial_at_least(NOTE_HEADER, NOTE_LEAST)(F.lower(s)), "reason": s.rlike(r"(?i)^\W{0,4}reason\W")}
    pages = lines.groupBy("case_id", "page").agg(*[F.coalesce(F.bool_or(sign), F.lit(False)).alias(name) for name, sign in signs.items()])
    told, n = F.array_compact(F.array(*[F.when(F.col(x), x) for x in signs])), sum((F.col(x).cast("int") for x in signs), F.lit(0))
    return pages.select("case_id", "page", F.array_join(told, ",").alias("signals"), (n >= 2).alias("note_like"))


def anchors(lines: DataFrame, titles: list[str]) -> DataFrame:
    """case_id, page, anchor: content (a title or a label stands on the page, if damaged), wrapper (only what the packet
    puts on every page) or none."""
    n = X.compact(F.col("text"))
    noise = n.isin(NOISE + ["packetmib"])
    wrapper = F.regexp_replace("text", " ", "").rlike(r"(?i)MIB-?\d{6}") | noise | X.is_watermark(F.col("text"))
    near = F.lit(False)
    for a in dict.fromkeys([*titles, *(label for label, _ in LABELS)]):
        hit = F.contains(n, F.lit(a))
        if len(a) >= 7:
            hit = hit | ((F.length(n) >= 5) & (Z.partial(n, a) >= 82))
        near = near | hit
    own = once(lines, "text", [{"content": ~noise & near, "wrapper": wrapper}])
    pages = own.where(n != "").groupBy("case_id", "page").agg(F.bool_or("content").alias("content"), F.bool_or("wrapper").alias("wrapper"))
    return lines.select("case_id", "page").distinct().join(pages, ["case_id", "page"], "left").select("case_id", "page", F.when(F.col("content"), "content").when(F.col("wrapper"), "wrapper").otherwise("none").alias("anchor"))


def embargo_pages(lines: DataFrame) -> DataFrame:
    """case_id, page: registry pages with an embargo, on a status line itself or at the head of one of the two below it."""
    w = Window.partitionBy("case_id", "page").orderBy("line_no")
    head = lambda k: F.coalesce(F.lead("text", k).over(w).rlike(EMBARGO_HEAD), F.lit(False))
    below = lines.withColumn("below", head(1) | head(2))
    said = F.col("text").rlike(EMBARGO_STATUS) | (F.col("text").rlike(r"(?i)registry\s*status") & F.col("below"))
    return below.where(said).select("case_id", "page").distinct()


def names(rows: DataFrame, read: str) -> DataFrame:
    """rows with ``name``: the first two capitalised words of a read, after words that are parts of a label; null with fewer."""
    labels = F.transform("words", lambda w: F.greatest(*[Z.ratio(F.lower(w), x) for x in NAME_LABELS]) >= 70)
    two = F.when(F.col("first") > 0, F.slice("words", F.greatest("first", F.lit(1)), 2))
    return once(rows, read, [
        {"words": F.regexp_extract_all(read, F.lit("[A-Z][a-z]+"), F.lit(0))},
        {"first": F.coalesce(F.array_position(labels, False), F.lit(0)).cast("int")},
        {"two": two},
        {"name": F.when(F.size("two") == 2, F.array_join("two", " "))},
    ])


def enums(rows: DataFrame, read: str, field: str) -> DataFrame:
    """rows with ``value`` and ``score``: the legal value that a read stands for. A world under embargo takes a closer read,
    as it would deny; a negated value stands for none."""
    best, score = F.col("r.best"), F.col("r.score")
    banned = best.isin(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS) & (score < EMBARGO_LEAST) if field == "home_world" else F.lit(False)
    good = (plain(F.col(read)) != "") & (score >= ENUM_LEAST) & ~banned & ~X.negates(F.col(read), best)
    return once(rows, read, [{"r": Z.ranked(plain(F.col(read)), VOCABULARIES[field])}, {"good": good}, {"value": F.when(F.col("good"), best), "score": F.when(F.col("good"), score)}])


def flag_lists(rows: DataFrame, read: str) -> DataFrame:
    """rows with ``value`` and ``score`` of a damaged list of flags: each part snapped without a second ranking; what stands
    for no flag is never a confident none."""
    parts = F.filter(F.transform(F.split(read, r"[|,;]+"), lambda x: F.trim(x)), lambda x: (x != "") & ~X.compact(x).isin("none", "nane", "n0ne", "norne"))
    found = F.filter(F.transform("ranks", lambda r: F.when(r["score"] >= FLAG_LEAST, r["best"])), lambda x: x.isNotNull())
    score = F.when(F.size("found") > 0, 85).when(F.size("parts") > 0, 40).otherwise(90)
    return once(rows, read, [{"parts": parts}, {"ranks": F.transform("parts", lambda x: Z.ranked(x, vocab.FLAGS))}, {"found": found}, {"value": X.flag_text(F.col("found")), "score": score}])


def unique_enums(rows: DataFrame, read: str) -> DataFrame:
    """rows with ``field`` and ``value`` if a read is close to a value of exactly one field, with a clear lead and nearly
    nothing else in it; null if it is of none or of several."""
    body, ranks, found = X.compact(F.col(read)), {}, []
    for field, choices in VOCABULARIES.items():
        ranks[f"r_{field}"] = Z.ranked(plain(F.col(read)), choices)
        r = F.col(f"r_{field}")
        whole = F.coalesce(*[F.when(r["best"] == c, Z.ratio(body, c.lower())) for c in choices])
        found.append(F.when((r["score"] >= 85) & (r["margin"] >= 8) & (whole >= 80), F.struct(F.lit(field).alias("field"), r["best"].alias("value"))))
    only = F.when(F.size("found") == 1, F.element_at("found", 1))
    return once(rows, read, [ranks, {"found": F.array_compact(F.array(*found))}, {"only": only}, {"field": F.col("only.field"), "value": F.col("only.value")}])


def decoded_names(rows: DataFrame, read: str, first: list[str], last: list[str]) -> DataFrame:
    """rows with ``decoded`` and ``legal``. A name read is held against a lexicon: an exact one stays; else the nearest joint
    name, if it is close or one word of the read is in the lexicon as it stands; else words by themselves where one is;
    else the read as it is. It is legal if it is two words that each come near one of the lexicon."""
    s, a, b = F.col(read), F.try_element_at("words", F.lit(1)), F.try_element_at("words", F.lit(2))
    near = lambda r, w: F.when(F.col(r)["score"] >= 75, F.col(r)["best"]).otherwise(w)
    ranks = {"ra": Z.ranked(a, first), "rb": Z.ranked(b, last), "rj": Z.ranked(s, [f"{x} {y}" for x in first for y in last])}
    told = {"alone": F.concat_ws(" ", near("ra", a), near("rb", b)), "anchored": a.isin(first) | b.isin(last)}
    exact = a.isin(first) & b.isin(first) & (F.col("alone") == s)
    joint = (F.col("rj.score") >= 55) & ((F.col("rj.score") >= 85) | F.col("anchored"))
    decoded = F.when(F.size("words") != 2, s).when(exact, s).when(joint, F.col("rj.best")).when(F.col("anchored"), F.col("alone")).otherwise(s)
    legal = (F.size("words") == 2) & F.coalesce((F.col("ra.score") >= 75) & (F.col("rb.score") >= 75), F.lit(False))
    return once(rows, read, [{"words": F.split(s, " ")}, ranks, told, {"decoded": decoded, "legal": legal}])


def completion(fragment: Column) -> Column:
    """The flag that a fragment is the end of, if it is of exactly one and that one disqualifies."""
    x = F.regexp_replace(F.lower(fragment), "[^a-z_]", "")
    ends = F.filter(F.array(*map(F.lit, vocab.FLAGS)), lambda f: F.endswith(f, x))
    only = F.when(F.size(ends) == 1, F.element_at(ends, 1))
    return F.when(F.length(x).between(5, 8) & x.rlike("^[a-z]+_[a-z]+$") & only.isin(vocab.DISQUALIFYING_FLAGS), only)


def labelled_fields(rows: DataFrame, read: str) -> DataFrame:
    """rows with ``field`` and ``value`` of a line whose part before a colon or stop comes near a label; the first label at
    ties; null for other lines."""
    pattern = r"^([^:]{3,26})[:.](.+)$"
    scored = F.array(*[F.struct((-F.greatest(Z.partial(F.col("head"), label), Z.ratio(F.col("head"), label))).alias("low"), F.lit(i).alias("i"), F.lit(field).alias("field")) for i, (label, field) in enumerate(LABELS)])
    good = F.col(read).rlike(pattern) & (F.length("head") >= 4) & (-F.col("best.low") >= LABEL_LEAST)
    value = F.trim(F.regexp_extract(read, pattern, 2))
    return once(rows, read, [{"head": X.compact(F.regexp_extract(read, pattern, 1))}, {"best": F.array_min(scored)}, {"good": good}, {"field": F.when(F.col("good"), F.col("best.field")), "value": F.when(F.col("good"), value)}])


def hidden_signals(hidden: DataFrame) -> DataFrame:
    """case_id, spans, and what a case's hidden lines (case_id, text) hold: an answer key, a system prompt, and mentions of a
    sponsor, a date or a decision. They lower trust and are never evidence."""
    has = lambda pattern: F.bool_or(F.col("text").rlike(pattern))
    return hidden.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("spans"),
        has("(?i)answer key").alias("answer_key"),
        has("SYSTEM:").alias("system_prompt"),
        has(r"SPN-\d{4}").alias("sponsor"),
        has(r"\d{4}-\d{2}-\d{2}").alias("date"),
        has("APPROVED|DENIED|NEEDS_REVIEW").alias("adjudication"),
    )


def present(truth: Column, corpus: Column) -> Column:
    """Whether a fee status stands in a normalized text by itself: "paid" inside "unpaid" doesn't count."""
    times = lambda x: F.regexp_count(corpus, x)
    return F.when(truth == "paid", times(F.lit("paid")) > times(F.lit("unpaid"))).otherwise(F.contains(corpus, X.compact(truth)))


def template_key(s: Column) -> Column:
    """struct(kind, label, value) of a template's key, "l/label" or "v/label/value"; null for other keys. A value may hold
    strokes of its own."""
    parts = F.split(s, "/", 3)
    label, value = F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(3))
    is_label = (parts[0] == "l") & (F.size(parts) == 2) & (label != "")
    is_value = (parts[0] == "v") & (F.size(parts) == 3) & (label != "") & (value != "")
    return F.when(is_label | is_value, F.struct(parts[0].alias("kind"), label.alias("label"), F.when(is_value, value).alias("value")))


def mined_pairs(labelled: DataFrame, truth: DataFrame) -> DataFrame:
    """field, pairs, clean, garbled: reads of labelled lines (case_id, field, value) beside the true values of their case
    (case_id, field, tgt); a pair is clean if both are the same but for case, white space and stops."""
    both = labelled.join(truth.where("tgt <> ''"), ["case_id", "field"])
    clean = F.count_if(X.compact(F.col("value")) == X.compact(F.col("tgt")))
    return both.groupBy("field").agg(F.count(F.lit(1)).alias("pairs"), clean.alias("clean")).withColumn("garbled", F.col("pairs") - F.col("clean"))
