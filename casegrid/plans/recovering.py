"""Queries over the recovery of a batch, with the SQL they are held against."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import vocab
from ..operators import recovery as R
from ..operators import supervise as V
from .projection import SPARK, TABLES, frame, oracle, views

STATES = "select case_id, case_no, case when case_no % 7 = 0 then 'ValueError: bad page' end as error, cast(case_no % 3 as int) as n_pools, cast(case_no % 2 as int) as n_notes from cases"
TRIES = "select case_no, attempt, event_id, case when event_id % 11 = 0 then null when status = 'ok' then 'success' else 'failed' end as status, case when status = 'failed' and event_id % 5 <> 0 then kind end as failure_category from attempts"
RESPAWNS = "select user_id as shard, ts, event_id, cast(100 - (event_id * event_id) % 60 as int) as remaining from events"
RUNS = "select case_id, cast(case_no % 7 - 1 as int) as level, cast((case_no * 37) % 240 as int) as seconds, case when case_no % 3 = 0 then 'APPROVED' else 'DENIED' end as decision from cases"
NUMBERED = "select doc_id, row_number() over (order by n_chars, doc_id) as ordinal from documents"
FIELDS = ";".join(f"{k}={v}" for k, v in vocab.FALLBACKS.items())
CATEGORY = "case when coalesce(l.status, '') = 'success' then null else coalesce(l.failure_category, case when s.error is not null then 'extraction_error' end, case when n_pools = 0 and n_notes = 0 then 'recognizable_stub' end) end"
RETRYABLE = f"s as ({STATES}), tries as ({TRIES}), l as (select case_no, arg_max(struct_pack(status := status, failure_category := failure_category), cast(attempt as bigint) * 1000000000 + event_id) as last from tries group by case_no), k as (select case_no, last.status as status, last.failure_category as failure_category from l), r as (select s.case_no, s.case_id, {CATEGORY.replace('l.', 'k.')} as category from s left join k on k.case_no = s.case_no)"


def given(spark, sf_dir: str, text: str):
    """A text over tables and views, in the words that both engines share."""
    names = sorted({n for n in re.findall(r"\b(?:from|join)\s+(\w+)", text) if n in TABLES or n in views(SPARK)})
    text = re.sub(rf"\b(from|join)\s+({'|'.join(names)})\b", r"\1 {\2}", text)
    return spark.sql(text, **{n: frame(spark, sf_dir, n) for n in names})


def numbered(spark, sf_dir):
    return V.scheduled(frame(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"]).select("doc_id", "ordinal")


def candidates(spark, sf_dir):
    return R.retryable(given(spark, sf_dir, STATES), given(spark, sf_dir, TRIES))


def retried_attempts(spark, sf_dir):
    a = frame(spark, sf_dir, "attempts")
    return V.first_wins(a, ["case_no"], ["event_id"]), V.first_wins(a.where("attempt > 1 and status = 'ok'"), ["case_no"], ["event_id"])


QUERIES = {
    "retryable_states": (candidates, oracle(("cases", "attempts"), f"with {RETRYABLE} select * from r where category is not null")),
    "retry_plan": (
        lambda s, d: R.retry_plan(candidates(s, d), ["case_no"]),
        oracle(("cases", "attempts"), f"with {RETRYABLE}, o as (select *, row_number() over (order by case_no) as ordinal from r where category is not null) select *, case when ordinal <= 128 then 'retried' else 'retry_budget_exhausted' end as outcome from o"),
    ),
    "emission_order": (
        lambda s, d: R.emission_order(numbered(s, d), 7),
        f"with n as ({NUMBERED}) select doc_id, ordinal, cast((ordinal - 1) % 7 as int) as slice, row_number() over (order by (ordinal - 1) % 7, ordinal) as place from n",
    ),
    "no_progress_strikes": (
        lambda s, d: R.strikes(given(s, d, RESPAWNS)),
        f"""with recursive r as ({RESPAWNS}), o as (select *, row_number() over (partition by shard order by ts, event_id) as n, lag(remaining) over (partition by shard order by ts, event_id) as before from r),
          f as (select shard, n, 0 as strikes from o where n = 1 union all select o.shard, o.n, case when o.remaining < o.before then 0 else f.strikes + 1 end from f join o on o.shard = f.shard and o.n = f.n + 1 where f.strikes < 3)
          select shard, max(n) as respawns, cast(arg_max(strikes, n) as int) as strikes, max(strikes) = 3 as given_up from f group by shard""",
    ),
    "work_shedding": (
        lambda s, d: given(s, d, RUNS).withColumn("x", R.shed(F.col("level"))).select("case_id", "level", "x.max_pages", "x.max_hq", "x.scan_ocr", "x.timeout_s"),
        oracle(("cases",), f"with r as ({RUNS}) select case_id, r.level, m.max_pages, m.max_hq, m.scan_ocr, m.timeout_s from r join (values (0, 4, 2, true, 150), (1, 2, 1, true, 150), (2, 0, 0, false, 150), (3, 0, 0, false, 60), (4, 0, 0, false, 20)) as m(level, max_pages, max_hq, scan_ocr, timeout_s) on m.level = greatest(0, least(4, r.level))"),
    ),
    "case_timeouts": (
        lambda s, d: R.timed_out(given(s, d, RUNS)),
        oracle(("cases",), f"""with r as (select *, seconds > case when level >= 4 then 20 when level = 3 then 60 else 150 end as late from ({RUNS}))
          select case_id, if(late, 'failed', 'success') as status, if(late, 'case_timeout', null) as failure_category, if(late, 'NEEDS_REVIEW', decision) as decision, if(late, '{FIELDS}', null) as fields from r"""),
    ),
    "finalisation_boundary": (
        lambda s, d: R.finalised(frame(s, d, "customer").select(F.col("c_custkey").alias("user_id")), frame(s, d, "events").where("event_type = 'purchase'").select("user_id", "ts"), F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), "user_id"),
        "with f as (select user_id, min(ts) as first from events where event_type = 'purchase' group by user_id) select c_custkey as user_id, case when first is null then 'missing' when first <= timestamp '2024-01-10' then 'done' else 'late' end as status from customer left join f on f.user_id = c_custkey",
    ),
    "inspector_chunks": (
        lambda s, d: R.inspected(numbered(s, d), F.col("doc_id") % 101 == 0, F.col("doc_id") % 505 == 0),
        f"with n as ({NUMBERED}), c as (select (ordinal - 1) // 48 as chunk, count(*) as n, bool_or(doc_id % 101 = 0) as a, bool_or(doc_id % 505 = 0) as b from n group by all) select chunk, n, case when a then 2 else 1 end as tries, case when a and b then 'failed_closed' else 'inspected' end as outcome from c",
    ),
    "completion_counter": (
        lambda s, d: R.completions(frame(s, d, "attempts").where("status = 'ok'"), F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")),
        oracle(("attempts",), "with g as (select shard, date_trunc('hour', ts) as bucket, count(*) as n from attempts where status = 'ok' group by all) select *, cast(sum(n) over (partition by shard order by bucket) as bigint) as completed from g"),
    ),
    "stitched_estimate": (
        lambda s, d: R.stitched(*retried_attempts(s, d), "case_no"),
        oracle(("attempts",), """with p as (select case_no, arg_min(status, event_id) as status from attempts group by case_no), r as (select case_no, arg_min(status, event_id) as again from attempts where attempt > 1 and status = 'ok' group by case_no)
          select p.case_no, coalesce(again, status) as status, case when again is null then 'primary' else 'retry' end as origin, case when (select count(*) from r) > 0 then 'estimate' else 'measured' end as published from p left join r on r.case_no = p.case_no"""),
    ),
    "common_cases": (
        lambda s, d: R.common_cases(frame(s, d, "truth"), frame(s, d, "candidates").select("case_id").distinct(), frame(s, d, "native").select("case_id").distinct()),
        oracle(("truth", "candidates", "native"), """with t as (select distinct case_id, true as t from truth), p as (select distinct case_id, true as p from candidates), l as (select distinct case_id, true as l from native),
          j as (select coalesce(t, false) as t, coalesce(p, false) as p, coalesce(l, false) as l from t full join p using (case_id) full join l using (case_id))
          select count(*) filter (where t and p and l) as common, count(*) filter (where not t) as without_truth, count(*) filter (where p and not l) as prediction_only, count(*) filter (where l and not p) as ledger_only, not bool_or(p <> l) as matched from j"""),
    ),
    "best_reads": (
        lambda s, d: R.best_reads(frame(s, d, "candidates").where("value <> ''")),
        oracle(("candidates",), "select case_id, field, value, score from candidates where value <> '' qualify row_number() over (partition by case_id, field order by score desc, ord) = 1"),
    ),
    "mean_confidence": (
        lambda s, d: R.mean_confidence(frame(s, d, "lines")),
        oracle(("lines",), "with p as (select case_id, page, avg(conf) as c from lines group by all) select case_id, round(avg(c) + 1e-9, 2) as confidence from p group by case_id"),
    ),
    "taint_sets": (
        lambda s, d: R.taint_sets(frame(s, d, "struck").where("scope = 'global'"), frame(s, d, "struck").where("scope = 'local'")),
        oracle(("struck",), "select case_id, token, bool_or(scope = 'global') as is_global, not bool_or(scope = 'global') as ambiguous from struck group by all"),
    ),
}
