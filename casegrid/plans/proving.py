"""Audits that hold a run to its full terms, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..operators import audit as A
from ..operators import pages as R
from .auditing import FALLBACK, HIDDEN, IDENTITY, hidden, judged_sql, rows_sql, unpivot
from .fusing import fields_of, judged
from .grammar import WATERMARK
from .projection import frame, oracle

#: Leaks where only lines before a page's first watermark clear a value.
TRUSTED = f"""{rows_sql('pred', 'native')}, {HIDDEN}, em as ({unpivot('pred', IDENTITY)}), hd as (select case_id, string_agg(distinct text, chr(10) order by text) as hidden from hidden group by case_id),
 marks as (select *, max(case when {WATERMARK} then 1 else 0 end) over (partition by case_id, page order by line_no rows between unbounded preceding and current row) as mark from lines),
 leaks as (select e.case_id, field, value from em e join hd on hd.case_id = e.case_id where value <> '' and value <> {FALLBACK} and contains(lower(hidden), lower(value))
   and not exists (select 1 from marks l where mark = 0 and l.case_id = e.case_id and contains(lower(l.text), lower(e.value))))"""
SIGNED = "select case_id, field, list_sort(list(distinct value)) as vs from {} where rank = 1 and value <> '' group by all"


def leaked(spark, sf_dir):
    return A.leaks(fields_of(spark, sf_dir, "native", IDENTITY), hidden(spark, sf_dir), R.trusted(frame(spark, sf_dir, "lines")), IDENTITY)


def failures(spark, sf_dir):
    """Cases whose last attempt failed."""
    last = frame(spark, sf_dir, "attempts").groupBy("case_no").agg(F.max_by("status", F.struct("attempt", "event_id")).alias("status"))
    return last.where("status = 'failed'").join(frame(spark, sf_dir, "cases").select("case_no", "case_id"), "case_no").select("case_id")


def gates(spark, sf_dir):
    truth = frame(spark, sf_dir, "truth").select("case_id", "adjudication")
    return A.five_gates(judged(spark, sf_dir, "candidates"), judged(spark, sf_dir, "native"), truth, failures(spark, sf_dir), A.signed_values(frame(spark, sf_dir, "candidates")), A.signed_values(frame(spark, sf_dir, "native")))


COMPARED = vocab.FIELDS

QUERIES = {
    "leak_audit_trusted": (leaked, oracle(("native", "reads", "lines"), f"with {TRUSTED} select * from leaks")),
    "answer_keys_of_two": (
        lambda s, d: A.answer_keys(leaked(s, d), 2),
        oracle(("native", "reads", "lines"), f"with {TRUSTED} select case_id, count(distinct field) as n from leaks group by case_id having count(distinct field) >= 2"),
    ),
    "answer_keys_of_three": (
        lambda s, d: A.answer_keys(leaked(s, d)),
        oracle(("native", "reads", "lines"), f"with {TRUSTED} select case_id, count(distinct field) as n from leaks group by case_id having count(distinct field) >= 3"),
    ),
    "five_gates": (
        gates,
        oracle(("candidates", "native", "cases", "truth", "attempts"), f"""with {judged_sql('a', 'candidates')}, {judged_sql('b', 'native')}, sb as ({SIGNED.format('candidates')}), sv as ({SIGNED.format('native')}),
          f as (select case_no from attempts group by case_no having arg_max(status, cast(attempt as bigint) * 1000000000 + event_id) = 'failed'),
          g as (select 'zero_new_false_approvals' as gate, count(*) as n from a join b using (case_id) join truth t using (case_id) where b.decision = 'APPROVED' and t.adjudication <> 'APPROVED' and a.decision <> 'APPROVED'
            union all select 'zero_execution_failures', count(*) from f join cases using (case_no)
            union all select 'baseline_rank1_noninferiority', count(distinct sb.case_id) from sb left join sv on sv.case_id = sb.case_id and sv.field = sb.field where len(sb.vs) = 1 and not coalesce(list_contains(sv.vs, sb.vs[1]), false)
            union all select 'zero_new_rank1_conflicts', count(distinct sv.case_id) from sv left join sb on sb.case_id = sv.case_id and sb.field = sv.field where len(sv.vs) > 1 and coalesce(len(sb.vs), 0) < 2
            union all select 'rank1_conflicts_force_review', count(distinct sv.case_id) from sv join b on b.case_id = sv.case_id where len(sv.vs) > 1 and b.decision <> 'NEEDS_REVIEW')
          select gate, n = 0 as passed, n from g union all select 'promotion_eligible', bool_and(n = 0), cast(sum(n) as bigint) from g"""),
    ),
    "decision_diff": (
        lambda s, d: A.decision_diff(judged(s, d, "candidates"), judged(s, d, "native"), COMPARED),
        oracle(("candidates", "native", "cases"), f"""with {judged_sql('a', 'candidates')}, {judged_sql('b', 'native')}, j as (select coalesce(a.case_id, b.case_id) as case_id, a.case_id is null or b.case_id is null as alone, {', '.join(f'a.{f} as a_{f}, b.{f} as b_{f}' for f in ['decision', *COMPARED])} from a full join b on b.case_id = a.case_id),
          k as (select case_id, array_to_string(list_filter([{', '.join(f"case when alone or a_{f} is distinct from b_{f} then '{f}' end" for f in ['decision', *COMPARED])}], lambda x: x is not null), ',') as changed, coalesce(b_decision = 'APPROVED' and a_decision is distinct from 'APPROVED', false) as entered_approved from j) select * from k where changed <> ''"""),
    ),
}
