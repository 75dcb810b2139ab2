"""Queries over whole batches: batch statistics, strikes, policy, and the decision program."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import text as X
from ..operators import batch as B
from ..operators import calibrate as C
from ..operators import columnar as K
from ..operators import evidence as E
from ..operators import gates as G
from ..operators import policy as P
from ..operators import strikes as S
from .projection import frame, oracle
from .selection import select_sql


def q(names: list[str]) -> str:
    return ", ".join(f"'{x}'" for x in names)


DAY = "case when regexp_full_match(value, '\\d{4}-\\d{2}-\\d{2}') then try_cast(value as date) end"
META = """created_at as (select created as d, row_number() over (order by created) as n, count(*) over () as t from cases where created is not null),
 meta as (select cast(case when date_diff('day', date '2026-06-29', d) >= 14 then least(date_diff('day', date '2026-06-29', d), 3650) else 0 end as int) as shift from created_at where n = t // 2 + 1)"""
EPOCH = f"""{META}, good as (select {DAY} as d from candidates where field = 'arrival_date' and score >= 90),
 ranked as (select d, row_number() over (order by d) as n, count(*) over () as t from good where d is not null),
 p as (select d as p90, t from ranked where n = greatest(0, cast(floor(0.9 * t) as int) - 1) + 1),
 near as (select d, p90, t, row_number() over (order by d desc) as m from ranked cross join (select d as p90 from ranked where n = greatest(0, cast(floor(0.9 * t) as int) - 1) + 1) where d <= p90 + 60),
 b as (select max(t) as n, max(p90) as p90, case when date_diff('day', max(case when m = 2 then d end), max(case when m = 1 then d end)) > 45 then max(case when m = 2 then d end) else max(case when m = 1 then d end) end as bulk from near),
 epoch as (select n, p90, bulk, cast(case when date_diff('day', date '2026-06-25', p90) >= 14 then date_diff('day', date '2026-06-25', p90) else 0 end as int) as shift, meta.shift as meta,
   cast(case when n < 20 then date '2026-07-07' + meta.shift else greatest(date '2026-07-07', least(date '2026-07-07' + greatest(case when date_diff('day', date '2026-06-25', p90) >= 14 then cast(date_diff('day', date '2026-06-25', p90) as int) else 0 end, meta.shift), bulk)) end as date) as epoch from b cross join meta)"""
FREQUENT = f"""nc as (select count(distinct case_id) as n from candidates),
 freq as (select value as sponsor_id, count(distinct case_id) as n_cases from candidates where field = 'sponsor_id' and score >= 95 and regexp_full_match(value, 'SPN-\\d{{4}}') group by all),
 frequent as (select f.* from freq f cross join nc where nc.n >= 100 and f.n_cases >= greatest(4, cast(floor(0.004 * nc.n) as int)) and f.sponsor_id not in ({q(vocab.REVOKED_SPONSORS)})),
 mined as (select mined_sponsor as sponsor_id, count(*) as n from notes where regexp_full_match(mined_sponsor, 'SPN-\\d{{4}}') group by all having count(*) >= 2)"""
TOKENS = "list_append(list_transform(regexp_extract_all(value, '[A-Za-z0-9]+(?:[-_|][A-Za-z0-9]+)*'), lambda x: lower(x)), lower(value))"
COMPACT = "lower(regexp_replace({}, '[\\s.]+', '', 'g'))"
STRIKES = f"""everywhere as (select case_id, list(distinct lower(token)) as ts from struck where scope = 'global' group by all),
 marked as (select c.*, coalesce(list_has_any({TOKENS}, g.ts), false) as struck from candidates c left join everywhere g on g.case_id = c.case_id),
 taints as (select distinct c.case_id, c.field, lower(c.value) as value from candidates c join struck s on s.case_id = c.case_id and {COMPACT.format('c.value')} = {COMPACT.format('s.token')} where c.value <> ''),
 alive as (select m.* exclude (struck) from marked m where not struck and not exists (select 1 from taints t where t.case_id = m.case_id and t.field = m.field and t.value = lower(m.value)))"""
SET = "list_filter(string_split(coalesce({}, 'none'), '|'), lambda x: x not in ('none', ''))"


def blocking(field: str, value: str) -> str:
    return f"""(({field} = 'risk_flags' and list_has_any({SET.format(value)}, [{q(vocab.FLAGS)}])) or ({field} = 'fee_status' and {value} in ('unpaid', 'unknown', 'waived'))
      or ({field} = 'home_world' and {value} in ({q(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS)})) or ({field} = 'visa_class' and {value} = 'TRANSIT-7') or ({field} = 'sponsor_id' and {value} in ({q(vocab.REVOKED_SPONSORS)}))
      or ({field} = 'arrival_date' and {DAY.replace('value', value)} is not null))"""


def policy_sql(source: str, receipt: str = "receipt_date") -> str:
    """Columns deny and review (lists) of a row of fields."""
    flags, arrival = SET.format("risk_flags"), DAY.replace("value", "arrival_date")
    dip, given = "(coalesce(visa_class, '') = 'DIP-1')", f"(coalesce(arrival_date, '') <> '' and {receipt} is not null and coalesce(visa_class, '') <> 'DIP-1')"
    pick = lambda pairs: "list_filter([" + ", ".join(f"case when {g} then '{r}' end" for r, g in pairs) + "], lambda x: x is not null)"
    deny = [
        ("disqualifying_flag", f"list_has_any({flags}, [{q(vocab.DISQUALIFYING_FLAGS)}])"),
        ("unpaid_fee", "fee_status = 'unpaid'"),
        ("transit_visa", "visa_class = 'TRANSIT-7'"),
        ("embargoed_world", f"home_world in ({q(vocab.HARD_EMBARGO_WORLDS)}) or (home_world in ({q(vocab.SOFT_EMBARGO_WORLDS)}) and not {dip})"),
        ("revoked_sponsor", f"sponsor_id in ({q(vocab.REVOKED_SPONSORS)}) and not {dip}"),
        ("stale_application", f"{given} and date_diff('day', {arrival}, {receipt}) > 180"),
    ]
    review = [
        ("unparseable_date", f"{given} and {arrival} is null"),
        ("fee_unknown", "fee_status = 'unknown'"),
        ("review_flag", f"list_has_any({flags}, [{q(vocab.REVIEW_FLAGS)}])"),
        ("missing_visa", "coalesce(visa_class, '') = ''"),
        ("missing_sponsor", f"coalesce(sponsor_id, '') = '' and not {dip}"),
    ]
    return f"""select *, case when len(deny) > 0 then 'DENIED' when len(review) > 0 then 'NEEDS_REVIEW' else 'APPROVED' end as decision, case when len(deny) > 0 then deny when len(review) > 0 then review else ['clean'] end as reasons
      from (select *, {pick(deny)} as deny, {pick(review)} as review from {source})"""


def first_fields() -> str:
    """The values of each case's first page, as a row of fields."""
    return f"first as (select r.*, c.receipt_date from reads r join cases c on c.case_id = r.case_id where r.ord = 1), judged as ({policy_sql('first')})"


FIELDS = ", ".join(vocab.FIELDS)
_max = lambda expr, table: ", ".join(f"max(case when field = '{f}' then {expr} end) as {table}_{f}" for f in vocab.FIELDS)
CORR = f"""corr as (select case_id, field, arg_min(value, page * 100 + line_no) as value from (select case_id, page, line_no, replace(lower(regexp_extract(text, '(?i)^manual correction:\\s*([a-z ]+?)\\s*->\\s*(.*?)\\s*$', 1)), ' ', '_') as field,
   regexp_extract(text, '(?i)^manual correction:\\s*([a-z ]+?)\\s*->\\s*(.*?)\\s*$', 2) as value from lines) where field in ({q(vocab.FIELDS)}) and not contains(value, '/') and value <> '' and not regexp_matches(lower(value), '^[^a-z0-9]*(no|not|never)([^a-z0-9]|$)') group by all),
 signed as (select case_id, {_max('value', 's')} from corr group by case_id)"""
TWINS = f"""dd as (select *, date_diff('day', {DAY}, date '2026-07-07') between -30 and 180 as plausible, substr(value, 6, 5) as mmdd from alive where field = 'arrival_date' and {DAY} is not null),
 tw as (select case_id, mmdd, bool_or(plausible) as twin from dd group by all),
 pool as (select case_id, case_no, field, value, source, rank, score, ord from alive where field <> 'arrival_date' union all
   select d.case_id, case_no, field, value, source, rank, score, ord from dd d join tw t on t.case_id = d.case_id and t.mmdd = d.mmdd where plausible or not twin)"""
VOTE = f"""votes as (select case_id, chosen, pos, digit, count(*) as n, bool_or(g) as g from (select b.case_id, b.value as chosen, p.pos, substr(c.value, 5 + p.pos, 1) as digit, c.value in ({q(vocab.REVOKED_SPONSORS)}) as g
   from chosen b join pool c on c.case_id = b.case_id and c.field = 'sponsor_id' cross join (values (0), (1), (2), (3)) as p(pos)
   where b.field = 'sponsor_id' and regexp_full_match(b.value, 'SPN-\\d{{4}}') and regexp_full_match(c.value, 'SPN-\\d{{4}}') and hamming(c.value, b.value) <= 2) group by all),
 tops as (select *, max(n) over (partition by case_id, pos) as top from votes),
 digits as (select case_id, chosen, pos, bool_or(g) as g, case when sum(case when n = top then 1 else 0 end) > 1 then substr(chosen, 5 + pos, 1) else max(case when n = top then digit end) end as digit from tops group by case_id, chosen, pos),
 voted as (select case_id, case when bool_or(g) then chosen else concat('SPN-', string_agg(digit, '' order by pos)) end as voted from digits group by case_id, chosen)"""
NOTES = """absents as (select case_id, list(distinct absent_field) as absent from notes where absent_field is not null group by all),
 merged as (select case_id, arg_min(finding, rank * 1000 + page) filter (where finding is not null) as finding, arg_max(waiver_code, page) filter (where waiver_code is not null) as waiver_code, bool_or(registry_embargo) as registry_embargo,
   count(distinct case when rank = 1 then finding end) > 1 as conflict from notes group by case_id)"""
VALUES = ", ".join(f"coalesce(s.s_{f}, {'v.voted, ' if f == 'sponsor_id' else ''}e.e_{f}, '{v}') as {f}, (s.s_{f} is not null or e.e_{f} is not null) as read_{f}" for f, v in vocab.FALLBACKS.items())
READ = " + ".join(f"cast(read_{f} as int)" for f in vocab.FIELDS)
MISSING = "(cast((not read_risk_flags or (risk_flags = 'none' and coalesce(f_score < 85 and f_agree < 2, false))) as int) + " + " + ".join(f"cast(not read_{f} as int)" for f in vocab.DENY_RELEVANT[1:]) + ")"
NO_FLAGS = "(not read_risk_flags or (risk_flags = 'none' and coalesce(f_score < 85 and f_agree < 2, false)))"
AGE = f"date_diff('day', {DAY.replace('value', 'arrival_date')}, epoch)"
TRIGGER = " or ".join(f"(list_contains(reasons, '{r}') and read_{f})" for r, f in G.TRIGGERS.items())


def step(n: int, guard: str, decision: str, reason: str) -> str:
    return f"d{n} as (select * replace (case when coalesce({guard}, false) then {decision} else decision end as decision, case when coalesce({guard}, false) then [{reason}] else reasons end as reasons) from d{n - 1})"


CHAIN = [
    ("list_contains(absent, 'arrival_date') or (not read_arrival_date and n_read >= 5)", "'missing_arrival_date'"),
    ("list_contains(absent, 'sponsor_id') and visa_class <> 'DIP-1'", "'sponsor_blank'"),
    ("registry_embargo", "'registry_embargo_status'"),
    ("frequent and visa_class <> 'DIP-1'", "'batch_frequent_sponsor'"),
    ("fee_status = 'waived' and visa_class <> 'DIP-1' and upper(coalesce(waiver_code, 'N/A')) in ('N/A', 'NA', 'NONE')", "'waived_without_visible_waiver'"),
    (f"{NO_FLAGS} or not read_fee_status or {MISSING} > 1", f"concat('insufficient_evidence:', {MISSING})"),
]
HELD = " or ".join(f"coalesce({g}, false)" for g, _ in CHAIN)
WHY = "case " + " ".join(f"when {g} then {r}" for g, r in CHAIN) + " end"
DECIDE = f"""{EPOCH}, {FREQUENT}, {STRIKES}, {TWINS}, {select_sql('pool')}, {VOTE}, {CORR}, {NOTES},
 e as (select case_id, {_max('value', 'e')}, max(case when field = 'arrival_date' then source end) as d_source, max(case when field = 'arrival_date' then rank end) as d_rank, max(case when field = 'arrival_date' then score end) as d_score,
   max(case when field = 'arrival_date' then agreement end) as d_agree, max(case when field = 'risk_flags' then score end) as f_score, max(case when field = 'risk_flags' then agreement end) as f_agree from chosen group by case_id),
 blocked as (select distinct case_id, true as blocked from marked where struck and {blocking('field', 'value')}),
 sp as (select sponsor_id from frequent union select sponsor_id from mined),
 st as (select c.case_id, {VALUES}, e.* exclude (case_id), m.finding, m.waiver_code, coalesce(m.registry_embargo, false) as registry_embargo, coalesce(m.conflict, false) as conflict, coalesce(a.absent, []) as absent, coalesce(b.blocked, false) as blocked
   from cases c left join e on e.case_id = c.case_id left join voted v on v.case_id = c.case_id left join signed s on s.case_id = c.case_id left join merged m on m.case_id = c.case_id left join absents a on a.case_id = c.case_id left join blocked b on b.case_id = c.case_id),
 st1 as (select * replace (case when not read_home_world and list_contains({SET.format('risk_flags')}, 'planetary_embargo') then 'TRAPPIST-1e' else home_world end as home_world) from st),
 st2 as (select * replace (case when home_world in ({q(vocab.HARD_EMBARGO_WORLDS)}) and read_home_world then array_to_string(list_sort(list_distinct(list_append({SET.format('risk_flags')}, 'planetary_embargo'))), '|') else risk_flags end as risk_flags,
   case when regexp_full_match(waiver_code, 'DIP-WAIVER|HARDSHIP-\\d{{2,}}') and fee_status in ('none', 'paid') then 'waived' else fee_status end as fee_status), {READ} as n_read from st1),
 st3 as (select st2.*, epoch.epoch, sp.sponsor_id is not null as frequent from st2 cross join epoch left join sp on sp.sponsor_id = st2.sponsor_id),
 d0 as ({policy_sql('st3', 'epoch')}),
 {step(1, "decision = 'DENIED' and reasons = ['stale_application'] and d_source = 'unknown' and d_rank >= 6 and d_score < 85 and d_agree < 2", "'NEEDS_REVIEW'", "'weak_stale_date_evidence'")},
 {step(2, f"read_arrival_date and decision <> 'DENIED' and visa_class <> 'DIP-1' and {AGE} between 170 and 205", "'NEEDS_REVIEW'", "'stale_gray_zone'")},
 {step(3, f"read_arrival_date and decision = 'APPROVED' and visa_class <> 'DIP-1' and {AGE} < -30", "'NEEDS_REVIEW'", "'implausible_future_arrival'")},
 {step(4, f"(decision = 'DENIED' and not ({TRIGGER})) or (decision = 'APPROVED' and ({HELD}))", "'NEEDS_REVIEW'", f"case when decision = 'DENIED' then 'deny_trigger_unverified' else {WHY} end")},
 {step(5, "finding is not null", "finding", "'adjudicator_note'")},
 {step(6, "conflict", "'NEEDS_REVIEW'", "'rank1_note_conflict'")},
 {step(7, "decision = 'APPROVED' and blocked", "'NEEDS_REVIEW'", "'strike_cancellation_guard'")},
 decided as (select * replace (case when {DAY.replace('value', 'arrival_date')} is null then '2026-05-01' else arrival_date end as arrival_date), concat_ws(':', decision, split_part(reasons[1], ':', 1), cast(least(n_read, 9) as string)) as path from d7)"""
INPUTS = ("candidates", "cases", "notes", "struck", "lines")

#: What a case is known for besides its reads, for the steps that need it.
EXTRAS = """select case_id, case_no % 9 = 1 as guards, case when case_no % 4 = 1 then 'native_full_page_image' when case_no % 4 = 2 then 'visible_text_layer' when case_no % 4 = 3 then 'masked_pdf_render' else '' end as origin, case_no % 3 = 1 as preserved,
  case_no % 7 = 3 as layers, cast(case_no % 5 as int) as unmapped_fonts, cast(case when case_no % 11 = 4 then 1 else 0 end as int) as doubtful_pages, cast(case when case_no % 10 = 7 then 2 else 0 end as int) as fallback_pages,
  case case_no % 13 when 1 then 'DENIED' when 2 then 'NEEDS_REVIEW' when 3 then 'APPROVED' else '' end as recovered, case_no % 17 = 5 as strike_ambiguous, case when case_no % 2 = 0 then 'sponsor_id,home_world' else '' end as reconciled from cases"""
SILENT = "finding is null and not conflict"
LATER = [
    ("decision = 'APPROVED' and guards", "'NEEDS_REVIEW'", "'baseline_evidence_guard'"),
    ("finding is not null", "finding", "'adjudicator_note'"),
    ("conflict", "'NEEDS_REVIEW'", "'rank1_note_conflict'"),
    ("decision = 'APPROVED' and origin = 'native_full_page_image' and preserved", "'NEEDS_REVIEW'", "'native_finding_vs_baseline_guard'"),
    ("decision = 'APPROVED' and origin = 'visible_text_layer' and (layers or unmapped_fonts > 0)", "'NEEDS_REVIEW'", "'untrusted_container_text_layer'"),
    ("decision = 'APPROVED' and doubtful_pages > 0", "'NEEDS_REVIEW'", "'page_identity_ambiguous'"),
    ("decision = 'APPROVED' and fallback_pages > 0", "'NEEDS_REVIEW'", "'native_selector_fallback'"),
    (f"{SILENT} and ((recovered = 'DENIED' and decision = 'NEEDS_REVIEW') or (recovered = 'NEEDS_REVIEW' and decision in ('APPROVED', 'DENIED')))", "recovered", "'recovered_adjudicator_note'"),
    ("decision = 'APPROVED' and (strike_ambiguous or (unresolved and not (coalesce(finding, '') = 'APPROVED' and reasons = ['adjudicator_note'] and not conflict and origin in ('masked_pdf_render', 'visible_text_layer'))))", "'NEEDS_REVIEW'", "'strike_cancellation_guard'"),
]
DECIDE_ALL = (
    DECIDE[: DECIDE.index(" d5 as (")].replace(" d0 as (", f""" extra as ({EXTRAS}), open as (select m.case_id, bool_or(not list_contains(string_split(reconciled, ','), field)) as unresolved from marked m join extra using (case_id) where struck and {blocking('field', 'value')} group by m.case_id),
 st4 as (select st3.*, extra.* exclude (case_id), coalesce(unresolved, false) as unresolved from st3 join extra on extra.case_id = st3.case_id left join open on open.case_id = st3.case_id), d0 as (""").replace("from st3)", "from st4)")
    + ", ".join(step(k, *x) for k, x in enumerate(LATER, 5))
    + ","
    + DECIDE[DECIDE.index("\n decided as (") :].replace("from d7)", f"from d{4 + len(LATER)})")
)


def inputs(spark, sf_dir):
    return tuple(frame(spark, sf_dir, x) for x in ("reads", *INPUTS[1:]))


def emitted(rows):
    return G.each_case(rows.select("case_id", *vocab.FIELDS, "decision", F.array_join("reasons", ",").alias("reasons"), "n_read", "path", "n_cases"))


def first_page(spark, sf_dir):
    return frame(spark, sf_dir, "reads").where("ord = 1").join(frame(spark, sf_dir, "cases").select("case_id", "receipt_date"), "case_id")


CHANCES = {"approve": "(60 + l_suppkey % 37) / 100.0", "deny": "(l_partkey % 41) / 100.0", "review": "(l_partkey % 29) / 100.0"}

QUERIES = {
    "batch_epoch": (lambda s, d: B.batch_epoch(frame(s, d, "candidates"), frame(s, d, "cases")), oracle(("candidates", "cases"), f"with {EPOCH} select * from epoch")),
    "metadata_epoch_shift": (lambda s, d: B.metadata_shift(frame(s, d, "cases")), oracle(("cases",), f"with {META} select shift from meta")),
    "frequent_sponsors": (lambda s, d: B.frequent_sponsors(frame(s, d, "candidates")), oracle(("candidates", "notes"), f"with {FREQUENT} select * from frequent")),
    "mined_sponsors": (lambda s, d: B.mined_sponsors(frame(s, d, "notes")), oracle(("candidates", "notes"), f"with {FREQUENT} select * from mined")),
    "batch_sponsors": (lambda s, d: B.batch_sponsors(frame(s, d, "candidates"), frame(s, d, "notes")), oracle(("candidates", "notes"), f"with {FREQUENT} select sponsor_id from frequent union select sponsor_id from mined")),
    "strike_filter": (lambda s, d: K.surviving(frame(s, d, "reads"), frame(s, d, "struck")), oracle(("candidates", "struck"), f"with {STRIKES} select case_id, field, ord, value from alive")),
    "alias_taints": (lambda s, d: S.taints(frame(s, d, "candidates"), frame(s, d, "struck")), oracle(("candidates", "struck"), f"with {STRIKES} select * from taints")),
    "strike_block_fields": (
        lambda s, d: S.blocked_fields(S.with_strikes(frame(s, d, "candidates"), frame(s, d, "struck"))).select("case_id", F.array_join("fields", ",").alias("fields")),
        oracle(("candidates", "struck"), f"with {STRIKES} select case_id, array_to_string(list_sort(list(distinct field)), ',') as fields from marked where struck and {blocking('field', 'value')} group by case_id"),
    ),
    "policy_adjudicate": (
        lambda s, d: P.adjudicated(first_page(s, d)).select("case_id", "decision", F.array_join("reasons", ",").alias("reasons")),
        oracle(("reads", "cases"), f"with {first_fields()} select case_id, decision, array_to_string(reasons, ',') as reasons from judged"),
    ),
    "expected_value_decision": (
        lambda s, d: frame(s, d, "reads").where("ord = 1").select("case_id", P.best_expected(*[F.expr(x.replace("100.0", "100D")) for x in CHANCES.values()]).alias("decision")),
        oracle(("reads",), f"""with v as (select case_id, {CHANCES['approve']} * 8e0 + {CHANCES['deny']} * -4e0 as a, {CHANCES['deny']} * 8e0 as d, {CHANCES['review']} * 8e0 + ({CHANCES['approve']} + {CHANCES['deny']}) * 2e0 as r from reads where ord = 1)
          select case_id, case when a = greatest(a, d, r) then 'APPROVED' when d = greatest(a, d, r) then 'DENIED' else 'NEEDS_REVIEW' end as decision from v"""),
    ),
    "decide_gates": (
        lambda s, d: emitted(G.decide(*inputs(s, d))),
        oracle(INPUTS, f"with {DECIDE} select case_id, {FIELDS}, decision, array_to_string(reasons, ',') as reasons, n_read, path from decided"),
    ),
    "decide_all_steps": (
        lambda s, d: emitted(G.decide(*inputs(s, d), extras=s.sql(EXTRAS.replace("from cases", "from {cases}"), cases=frame(s, d, "cases")))),
        oracle(INPUTS, f"with {DECIDE_ALL} select case_id, {FIELDS}, decision, array_to_string(reasons, ',') as reasons, n_read, path from decided"),
    ),
    "decision_transition_census": (
        lambda s, d: C.met(G.decide(*inputs(s, d)), frame(s, d, "truth")).groupBy("adjudication", "decision").agg(F.sum("n").alias("n"), F.sum(P.score(F.col("decision"), F.col("adjudication")) * F.col("n")).cast("long").alias("points")),
        oracle((*INPUTS, "truth"), f"""with {DECIDE} select adjudication, decision, count(*) as n, cast(sum(case when decision = adjudication then 8 when decision = 'NEEDS_REVIEW' then 2 when decision = 'APPROVED' and adjudication = 'DENIED' then -4 when adjudication = 'NEEDS_REVIEW' then 1 else 0 end) as bigint) as points
          from decided join truth using (case_id) group by all"""),
    ),
}
