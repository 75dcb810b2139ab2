"""Audits of finished runs: leaks from untrusted text, differences of two runs, censuses of errors and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text as X


def unpivoted(rows: DataFrame, fields: list[str], key: str = "case_id") -> DataFrame:
    """key, field, value of wide rows."""
    return rows.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")).select(key, "x.*")


def leaks(predictions: DataFrame, hidden: DataFrame, lines: DataFrame, fields: list[str]) -> DataFrame:
    """case_id, field, value: emitted values that stand in a case's hidden text and in none of its trusted lines, and
    that aren't fallbacks."""
    fallback = F.create_map(*[F.lit(x) for f in fields for x in (f, vocab.FALLBACKS[f])])
    emitted = unpivoted(predictions, fields).where((F.col("value") != "") & (F.col("value") != fallback[F.col("field")]))
    found = emitted.join(hidden.groupBy("case_id").agg(F.concat_ws("\n", F.array_sort(F.collect_set("text"))).alias("hidden")), "case_id").where(F.contains(F.lower("hidden"), F.lower("value")))
    # the few emitted values are hashed and lines pass by them, so that no line is sorted
    trusted = lines.select(F.col("case_id").alias("_case"), F.lower("text").alias("_text"))
    f = found.select("case_id", "field", "value").distinct()
    seen = trusted.join(f.hint("shuffle_hash"), (F.col("_case") == F.col("case_id")) & F.contains(F.col("_text"), F.lower("value"))).select("case_id", "field", "value").distinct()
    return found.select("case_id", "field", "value").join(seen, ["case_id", "field", "value"], "left_anti")


def answer_keys(found: DataFrame, least: int = 3) -> DataFrame:
    """case_id, n: cases with so many leaked fields that an answer key was read."""
    return found.groupBy("case_id").agg(F.countDistinct("field").alias("n")).where(F.col("n") >= least)


def severity(counts: DataFrame) -> DataFrame:
    """One row, level: 2 with approvals that rest on leaks, 1 with leaks alone, 0 without."""
    return counts.agg(F.when(F.coalesce(F.sum("approved"), F.lit(0)) > 0, 2).when(F.coalesce(F.sum("leaks"), F.lit(0)) > 0, 1).otherwise(0).alias("level"))


def run_diff(base: DataFrame, variant: DataFrame, fields: list[str]) -> DataFrame:
    """case_id, field, base, variant: what differs between two runs; a case in one run alone differs in all fields."""
    a, b = unpivoted(base, fields), unpivoted(variant, fields)
    both = a.withColumnRenamed("value", "base").join(b.withColumnRenamed("value", "variant"), ["case_id", "field"], "full_outer")
    return both.where(~F.col("base").eqNullSafe(F.col("variant")))


def stability(base: DataFrame, variant: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """field, n, changed: how many pairs of reads of one key there are, and how many of them differ in each field. Reads
    meet whole, so that no row is made for each field."""
    a, b = (rows.select(*key, *[F.col(f).alias(f"{s}_{f}") for f in fields]) for rows, s in ((base, "a"), (variant, "b")))
    row = a.join(b, key).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"a_{f}") != F.col(f"b_{f}")).alias(f) for f in fields])
    told = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), "n", F.col(f).alias("changed")) for f in fields])).alias("x")
    return row.where("n > 0").select(told).select("x.*")


def promotion_gates(base: DataFrame, variant: DataFrame) -> DataFrame:
    """One row of gates over two decided runs (case_id, decision), and eligible, whether all hold."""
    # counted before they meet: rows of one case_id would meet each other row of it
    b, v = (rows.groupBy("case_id", F.col("decision").alias(d)).agg(F.count(F.lit(1)).alias(f"_{d}")) for rows, d in ((base, "b"), (variant, "v")))
    both = b.join(v, "case_id", "full_outer").withColumn("_n", F.coalesce("_b", F.lit(1)) * F.coalesce("_v", F.lit(1)))
    unlike = F.coalesce(F.sum(F.when(~F.col("b").eqNullSafe(F.col("v")), F.col("_n"))), F.lit(0))
    gates = {
        "same_cases": F.bool_and(F.col("b").isNotNull() & F.col("v").isNotNull()),
        "no_new_approval": ~F.bool_or(F.coalesce((F.col("v") == "APPROVED") & (F.col("b") != "APPROVED"), F.lit(False))),
        "no_lifted_denial": ~F.bool_or(F.coalesce((F.col("b") == "DENIED") & (F.col("v") != "DENIED"), F.lit(False))),
        "few_changes": unlike / F.sum("_n") <= 0.05,
    }
    row = both.agg(*[g.alias(n) for n, g in gates.items()], unlike.alias("changed"))
    eligible = F.lit(True)
    for n in gates:
        eligible = eligible & F.col(n)
    return row.withColumn("eligible", eligible)


def error_census(predictions: DataFrame, truth: DataFrame, fields: list[str]) -> DataFrame:
    """field, kind, n, examples: right, misread and fallback values of each field, with the first three cases of each."""
    fallback = F.create_map(*[F.lit(x) for f in fields for x in (f, vocab.FALLBACKS[f])])
    both = unpivoted(predictions, fields).join(unpivoted(truth, fields).withColumnRenamed("value", "true"), ["case_id", "field"])
    kind = F.when(F.col("value") == F.col("true"), "right").when(F.col("value") == fallback[F.col("field")], "fallback").otherwise("misread")
    told = both.select("field", kind.alias("kind"), "case_id")
    # each part keeps its first three of a kind before they meet, so no group is gathered whole
    first = F.row_number().over(Window.partitionBy("field", "kind").orderBy("case_id"))
    some = told.withColumn("_n", first).where("_n <= 3").groupBy("field", "kind").agg(F.array_join(F.array_sort(F.collect_list("case_id")), ",").alias("examples"))
    return told.groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n")).join(some, ["field", "kind"])


def threshold_grid(reads: DataFrame, nccs: list[float], margins: list[float]) -> DataFrame:
    """ncc, margin, n, precision over all pairs of thresholds. Reads are first counted by the highest thresholds that
    they pass, so the grid meets counts, not reads."""
    level = lambda c, steps: F.size(F.filter(F.array(*map(F.lit, steps)), lambda t: t <= F.col(c)))
    cells = reads.groupBy(level("ncc", nccs).alias("a"), level("margin", margins).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("k"))
    grid = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"), F.lit(x).alias("ncc"), F.lit(y).alias("margin")) for i, x in enumerate(nccs) for j, y in enumerate(margins)]))
    met = cells.select("a", "b", "n", "k", grid.alias("g")).where("a >= g.i and b >= g.j")
    return met.groupBy("g.ncc", "g.margin").agg(F.sum("n").alias("n"), (F.sum("k") / F.sum("n")).alias("precision"))


def rule_values(rows: DataFrame, weights: dict[str, int]) -> DataFrame:
    """rule, one column per truth, value, verdict: what it would be worth to let a rule decide."""
    agg = [F.count_if(F.col("adjudication") == t).alias(t.lower()) for t in weights]
    value = sum((F.col(t.lower()) * w for t, w in weights.items()), F.lit(0))
    return rows.groupBy("rule").agg(*agg).withColumn("value", value.cast("long")).withColumn("verdict", F.when(F.col("value") > 0, "keep").otherwise("drop"))


def digest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row, n and digest: the same for the same rows in any order; partial sums add up, so no task sees all rows."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns])
    number = F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(number).cast("long").alias("digest"))


def selector_ladder(pages: DataFrame, ladder: list[tuple[str, object]]) -> DataFrame:
    """outcome, n: how often each rung of an ordered ladder of predicates is the first to hold, with zero rows for the
    others and for ``selected``, which is none of them."""
    outcome = None
    for name, guard in ladder:
        outcome = F.when(guard, name) if outcome is None else outcome.when(guard, name)
    names = [n for n, _ in ladder] + ["selected"]
    counts = pages.groupBy(outcome.otherwise("selected").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    catalogue = pages.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "rung int, outcome string")
    return catalogue.join(counts, "outcome", "left").select("rung", "outcome", F.coalesce("n", F.lit(0)).alias("n"))


def violations(rows: DataFrame) -> DataFrame:
    """case_id, rule: rows of predictions that break the artefact's contract, once for each rule broken."""
    c = F.col
    rules = {
        "bad_id": ~F.coalesce(c("case_id").rlike(vocab.CASE_ID), F.lit(False)),
        "bad_date": X.real_date(c("arrival_date")).isNull(),
        "bad_sponsor": ~F.coalesce(c("sponsor_id").rlike(vocab.SPONSOR_ID), F.lit(False)),
        "bad_visa": ~c("visa_class").isin(vocab.VISAS),
        "bad_flags": F.size(F.array_except(X.flag_set(c("risk_flags")), F.array(*map(F.lit, vocab.FLAGS)))) > 0,
    }
    broken = F.array_compact(F.array(*[F.when(guard, F.lit(name)) for name, guard in rules.items()]))
    return rows.select("case_id", F.explode(broken).alias("rule"))


def signed_values(candidates: DataFrame) -> DataFrame:
    """case_id, field, values: the distinct values that the best rank gives a field, sorted; more than one is a conflict."""
    top = candidates.where((F.col("rank") == 1) & (F.col("value") != ""))
    return top.groupBy("case_id", "field").agg(F.array_sort(F.collect_set("value")).alias("values"))


def five_gates(base: DataFrame, variant: DataFrame, truth: DataFrame, failures: DataFrame, base_signed: DataFrame, variant_signed: DataFrame) -> DataFrame:
    """gate, passed, n: the gates that a variant of a run must pass, with the cases that speak against each, and whether it
    passes all. Runs have case_id and decision, truth case_id and adjudication, failures case_id, signed values as above."""
    # counted before they meet: each row of a case_id would meet all others of it
    told = lambda rows, guard, n: rows.where(guard).groupBy("case_id").agg(F.count(F.lit(1)).alias(n))
    new_false = told(variant, "decision = 'APPROVED'", "_v").join(told(base, "decision <> 'APPROVED'", "_b"), "case_id").join(told(truth, "adjudication <> 'APPROVED'", "_t"), "case_id")
    new_false, failed = new_false.agg(F.coalesce(F.sum(F.col("_v") * F.col("_b") * F.col("_t")), F.lit(0)).alias("n")), failures.agg(F.count(F.lit(1)).alias("n"))
    distinct = lambda cases: cases.agg(F.countDistinct("case_id").alias("n"))
    held = base_signed.where(F.size("values") == 1).select("case_id", "field", F.col("values")[0].alias("value"))
    kept = variant_signed.select("case_id", "field", F.explode("values").alias("value"))
    lost = held.join(kept, ["case_id", "field", "value"], "left_anti").select("case_id")
    clash = variant_signed.where(F.size("values") > 1).select("case_id", "field")
    added = clash.join(base_signed.where(F.size("values") > 1).select("case_id", "field"), ["case_id", "field"], "left_anti").select("case_id")
    unsafe = clash.select("case_id").distinct().join(variant.where("decision <> 'NEEDS_REVIEW'").select("case_id"), "case_id", "left_semi")
    gates = {"zero_new_false_approvals": new_false, "zero_execution_failures": failed, "baseline_rank1_noninferiority": distinct(lost), "zero_new_rank1_conflicts": distinct(added), "rank1_conflicts_force_review": distinct(unsafe)}
    rows = None
    for name, told in gates.items():
        row = told.select(F.lit(name).alias("gate"), (F.col("n") == 0).alias("passed"), "n")
        rows = row if rows is None else rows.unionByName(row)
    return rows.unionByName(rows.agg(F.lit("promotion_eligible").alias("gate"), F.bool_and("passed").alias("passed"), F.sum("n").alias("n")))


def decision_diff(base: DataFrame, variant: DataFrame, fields: list[str]) -> DataFrame:
    """case_id, changed, entered_approved: which fields, and whether the decision, differ between two runs of decided rows;
    cases that differ in nothing are left out, and one in a single run differs in all."""
    keep = ["decision", *fields]
    # like rows are counted before they meet, and told as often at the end: each row of a case_id meets all others of it
    b, v = (rows.groupBy("case_id", *[F.col(f).alias(f"{s}_{f}") for f in keep]).agg(F.count(F.lit(1)).alias(f"_{s}")) for rows, s in ((base, "b"), (variant, "v")))
    both = b.join(v, "case_id", "full_outer")
    alone = F.col("_b").isNull() | F.col("_v").isNull()
    changed = F.array_compact(F.array(*[F.when(alone | ~F.col(f"b_{f}").eqNullSafe(F.col(f"v_{f}")), f) for f in keep]))
    entered = (F.col("v_decision") == "APPROVED") & ~F.col("b_decision").eqNullSafe(F.lit("APPROVED"))
    n = F.coalesce("_b", F.lit(1)) * F.coalesce("_v", F.lit(1))
    told = both.select("case_id", F.array_join(changed, ",").alias("changed"), F.coalesce(entered, F.lit(False)).alias("entered_approved"), n.alias("_n")).where("changed <> ''")
    return told.select("case_id", "changed", "entered_approved", F.explode(F.sequence(F.lit(1), "_n")).alias("_k")).drop("_k")
