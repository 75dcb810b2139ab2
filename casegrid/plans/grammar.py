"""Queries over damaged reads, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..operators import grammar as G
from .projection import FIRST, LAST, frame, oracle
from .recovering import given

#: Lines as pages have them, some noise, damage, footers and note structure among them.
DAMAGED = """select case_id, page, line_no, case (page * 7 + line_no * 3 + length(text)) % 13 when 0 then 'PASSPORT IMAGE' when 1 then '[ washed out ]' when 2 then concat('Packet ', case_id, ' / page ', cast(page as string))
  when 3 then 'Home world: OBSCURED' when 4 then 'M.I.B.' when 5 then 'Manua1 Adjudcator N0te' when 6 then 'Finding - DENIED' when 7 then '* Reason: none given' when 8 then 'Registry Status' when 9 then 'EMB' else text end as text from lines"""
#: Reads of values with a character lost, doubled or misread.
READS = """select case_id, ord, case when l_partkey % 3 = 0 then replace(home_world, 'r', 'n') when l_partkey % 3 = 1 then concat(substr(home_world, 1, 3), substr(home_world, 5, 40)) else concat(home_world, '.') end as world,
  case when l_suppkey % 4 = 0 then concat('Applicant ', applicant_name) when l_suppkey % 4 = 1 then concat('Regstry Name ', applicant_name) when l_suppkey % 4 = 2 then lower(applicant_name) else applicant_name end as named,
  case when l_partkey % 4 = 0 then replace(applicant_name, 'a', 'o') when l_partkey % 4 = 1 then concat('X', applicant_name) when l_partkey % 4 = 2 then replace(applicant_name, ' ', '') else applicant_name end as person,
  case when l_partkey % 5 = 0 then replace(risk_flags, 'i', 'l') when l_partkey % 5 = 1 then concat(risk_flags, '; smudge') when l_partkey % 5 = 2 then 'n0ne' else risk_flags end as flags,
  case when l_suppkey % 5 = 0 then visa_class when l_suppkey % 5 = 1 then replace(species_code, '_', ' ') when l_suppkey % 5 = 2 then concat(declared_purpose, ' ') when l_suppkey % 5 = 3 then home_world else concat('the ', home_world) end as bare,
  case when l_partkey % 3 = 0 then 'zard_Red.' when l_partkey % 3 = 1 then right(risk_flags, 7) else 'ry_emb' end as fragment,
  case l_suppkey % 4 when 0 then concat('Home w0rld: ', home_world) when 1 then concat('Visa clas. ', visa_class) when 2 then concat('Purpse: ', declared_purpose) else concat('Remarks: ', home_world) end as line, fee_status from reads"""
WATERMARK = "regexp_matches(text, '(?i)\\b(sample|answer\\s*key|specimen|training copy)\\b')"


def quoted(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)


def lcs(choice: str, read: str) -> str:
    """Length of the common subsequence in DuckDB: a row of bits folded over the read's characters."""
    mask = f"cast(list_sum(list_transform(range(1, length({choice}) + 1), lambda i: case when substr({choice}, cast(i as int), 1) = ch then (1::bigint << cast(i - 1 as int)) else 0::bigint end)) as bigint)"
    return f"bit_count(list_reduce(list_prepend(0::bigint, list_transform(string_split({read}, ''), lambda ch: {mask})), lambda r, m: (r | m) & ~((r | m) - ((r << 1) | 1))))"


def ratio(choice: str, read: str) -> str:
    return f"(case when length({choice}) + length({read}) = 0 then 100e0 else 200e0 * {lcs(choice, read)} / (length({choice}) + length({read})) end)"


def partial(choice: str, read: str) -> str:
    """Best ratio over windows of the longer text; both are names of columns."""
    over = f"list_max(list_transform(range(1, length({read}) - length({choice}) + 2), lambda k: {ratio(choice, f'substr({read}, cast(k as int), length({choice}))')}))"
    under = f"list_max(list_transform(range(1, length({choice}) - length({read}) + 2), lambda k: {ratio(read, f'substr({choice}, cast(k as int), length({read}))')}))"
    return f"(case when length({read}) = 0 then 0e0 when length({read}) >= length({choice}) then {over} else {under} end)"


def ranking(reads: str, read: str, choices: list[str], name: str) -> str:
    """CTEs: for each distinct read its best choice, score and margin."""
    listed = f"(select unnest([{quoted(choices)}]) as c, unnest(range({len(choices)})) as i)"
    return f"""{name}_d as (select distinct {read} as x from {reads} where {read} is not null), {name}_s as (select x, c, i, {ratio('c', 'x')} as s from {name}_d cross join {listed}),
      {name} as (select x, arg_max(c, s * 1000 - i) as best, max(s) as score, max(s) - coalesce(max(s, 2)[2], 0e0) as margin from {name}_s group by x)"""


COMPACT = "lower(regexp_replace(text, '[\\s.]+', '', 'g'))"
STRIPPED = "regexp_replace({}, '^[ .:|]+|[ .:|]+$', '', 'g')"
NEGATED = "regexp_matches(lower({}), '^[^a-z0-9]*(no|not|never)([^a-z0-9]|$)')"


def reads(s, d):
    return given(s, d, READS)


def hidden_lines(s, d):
    from ..operators.pages import trusted

    lines = given(s, d, DAMAGED)
    return lines.join(trusted(lines).select("case_id", "page", "line_no"), ["case_id", "page", "line_no"], "left_anti").select("case_id", "text")


QUERIES = {
    "line_kinds": (
        lambda s, d: given(s, d, DAMAGED).select("case_id", "page", "line_no", G.line_kind(F.col("text")).alias("kind")),
        oracle(("lines",), f"""with l as ({DAMAGED}) select case_id, page, line_no, case when regexp_matches(text, '(?i)packet\\s*MIB[\\s-]*\\d{{6}}\\s*/?\\s*page') then 'footer' when {COMPACT} in ({quoted(G.NOISE)}) then 'noise'
          when regexp_matches(text, '(?i)(washed\\s*out|unreadable|cut\\s*out|blank|redacted|missing|torn|whiteout|white\\s*out|obscured|illegible|lost)\\s*\\]?\\s*$') then 'damage' else 'text' end as kind from l"""),
    ),
    "note_signals": (
        lambda s, d: G.note_signals(given(s, d, DAMAGED)),
        oracle(("lines",), f"""with l as ({DAMAGED}), t as (select distinct text, lower(trim(text)) as x, 'manual adjudicator note' as h from l), u as (select text, {partial('h', 'x')} >= 70 as header from t),
          g as (select l.case_id, l.page, unnest(list_filter([case when regexp_matches(trim(l.text), '(?i)^\\W{{0,4}}finding\\W') then 'finding' end, case when regexp_matches(trim(l.text), '(?i)^\\W{{0,4}}reason\\W') then 'reason' end, case when header then 'header' end], lambda x: x is not null)) as sign from l join u on u.text = l.text),
          p as (select case_id, page, list_sort(list(distinct sign)) as signs from g group by all)
          select a.case_id, a.page, coalesce(array_to_string(signs, ','), '') as signals, coalesce(len(signs), 0) >= 2 as note_like from (select distinct case_id, page from l) a left join p on p.case_id = a.case_id and p.page = a.page"""),
    ),
    "embargo_look_ahead": (
        lambda s, d: G.embargo_pages(given(s, d, DAMAGED)),
        oracle(("lines",), f"""with l as ({DAMAGED}), w as (select *, lead(text, 1) over p as a, lead(text, 2) over p as b from l window p as (partition by case_id, page order by line_no))
          select distinct case_id, page from w where regexp_matches(text, '(?i)embargo\\s*rev|mbargorev|bargorev') or (regexp_matches(text, '(?i)registry\\s*status') and (coalesce(regexp_matches(a, '(?i)^\\W*(emb|bargo|rgorev)'), false) or coalesce(regexp_matches(b, '(?i)^\\W*(emb|bargo|rgorev)'), false)))"""),
    ),
    "hidden_signals": (
        lambda s, d: G.hidden_signals(hidden_lines(s, d)),
        oracle(("lines",), f"""with l as ({DAMAGED}), w as (select *, max(case when {WATERMARK} then 1 else 0 end) over (partition by case_id, page order by line_no rows between unbounded preceding and current row) as mark from l)
          select case_id, count(*) as spans, bool_or(contains(lower(text), 'answer key')) as answer_key, bool_or(contains(text, 'SYSTEM:')) as system_prompt, bool_or(regexp_matches(text, 'SPN-\\d{{4}}')) as sponsor,
          bool_or(regexp_matches(text, '\\d{{4}}-\\d{{2}}-\\d{{2}}')) as date, bool_or(regexp_matches(text, 'APPROVED|DENIED|NEEDS_REVIEW')) as adjudication from w where mark = 1 group by case_id"""),
    ),
    "name_parse": (
        lambda s, d: G.names(reads(s, d).select("case_id", "ord", "named"), "named"),
        oracle(("reads",), f"""with r as ({READS}), t as (select distinct named, regexp_extract_all(named, '[A-Z][a-z]+') as words from r), k as (select named, unnest(words) as w, unnest(range(len(words))) as i from t),
          c as (select named, w, lower(w) as x, i, unnest(['applicant', 'registry', 'name']) as c from k), m as (select named, w, i, max({ratio('c', 'x')}) >= 70 as label from c group by all), f as (select named, min(i) as begins from m where not label group by named),
          n as (select m.named, string_agg(w, ' ' order by i) as name from m join f on f.named = m.named where i in (begins, begins + 1) group by m.named having count(*) = 2) select r.case_id, r.ord, r.named, n.name from r left join n on n.named = r.named"""),
    ),
    "enum_parse": (
        lambda s, d: G.enums(reads(s, d).select("case_id", "ord", "world"), "world", "home_world").select("case_id", "ord", "world", "value", F.round("score", 6).alias("score")),
        oracle(("reads",), f"""with r as (select *, {STRIPPED.format('world')} as plain from ({READS})), {ranking('r', 'plain', vocab.WORLDS, 'k')}, g as (select x, best, score from k where score >= 72 and not (best in ({quoted(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS)}) and score < 90))
          select case_id, ord, world, best as value, round(g.score, 6) as score from r left join g on g.x = r.plain"""),
    ),
    "flag_snap": (
        lambda s, d: G.flag_lists(reads(s, d).select("case_id", "ord", "flags"), "flags"),
        oracle(("reads",), f"""with r as ({READS}), t as (select distinct flags from r), p as (select flags, trim(unnest(regexp_split_to_array(flags, '[|,;]+'))) as part from t), q as (select * from p where part <> '' and lower(replace(part, ' ', '')) not in ('none', 'nane', 'n0ne', 'norne')), {ranking('q', 'part', vocab.FLAGS, 'k')},
          g as (select flags, list_sort(list(distinct best)) as found from q join k on k.x = q.part where k.score >= 78 group by flags), n as (select flags, count(*) as parts from q group by flags)
          select r.case_id, r.ord, r.flags, coalesce(array_to_string(found, '|'), 'none') as value, cast(case when found is not null then 85 when coalesce(parts, 0) > 0 then 40 else 90 end as int) as score from r left join g on g.flags = r.flags left join n on n.flags = r.flags"""),
    ),
    "unique_enum": (
        lambda s, d: G.unique_enums(reads(s, d).select("case_id", "ord", "bare"), "bare").where("field is not null"),
        oracle(("reads",), "with r as (select *, " + STRIPPED.format("bare") + " as plain, lower(regexp_replace(bare, '[\\s.]+', '', 'g')) as body from (" + READS + ")), " + ", ".join(ranking("r", "plain", v, f"k{i}") for i, v in enumerate(G.VOCABULARIES.values())) + ", t as (select distinct bare, plain, body from r), u as ("
          + " union all ".join(f"select bare, '{f}' as field, best as value, lower(best) as legal, body from t join k{i} on k{i}.x = t.plain where score >= 85 and margin >= 8" for i, f in enumerate(G.VOCABULARIES)) + f"), g as (select bare, min(field) as field, min(value) as value from u where {ratio('legal', 'body')} >= 80 group by bare having count(*) = 1) select r.case_id, r.ord, r.bare, g.field, g.value from r join g on g.bare = r.bare"),
    ),
    "name_joint_decode": (
        lambda s, d: G.decoded_names(reads(s, d).select("case_id", "ord", "person"), "person", FIRST, LAST),
        oracle(("reads",), f"""with r as ({READS}), t as (select distinct person, string_split(person, ' ') as w from r), v as (select person, w, w[1] as a, w[2] as b from t where len(w) = 2), {ranking('v', 'a', FIRST, 'ka')}, {ranking('v', 'b', LAST, 'kb')}, {ranking('v', 'person', [f'{x} {y}' for x in FIRST for y in LAST], 'kj')},
          m as (select v.person, concat(case when ka.score >= 75 then ka.best else a end, ' ', case when kb.score >= 75 then kb.best else b end) as alone, a in ({quoted(FIRST)}) or b in ({quoted(LAST)}) as anchored, kj.best as joint, kj.score as js, ka.score >= 75 and kb.score >= 75 as legal
          from v join ka on ka.x = v.a join kb on kb.x = v.b join kj on kj.x = v.person) select r.case_id, r.ord, r.person, case when m.person is null then r.person when js >= 55 and (js >= 85 or anchored) then joint when anchored then alone else r.person end as decoded, coalesce(legal, false) as legal from r left join m on m.person = r.person"""),
    ),
    "flag_completion_suffix": (
        lambda s, d: reads(s, d).select("case_id", "ord", "fragment", G.completion(F.col("fragment")).alias("flag")).where("flag is not null"),
        oracle(("reads",), f"""with r as (select *, regexp_replace(lower(fragment), '[^a-z_]', '', 'g') as x from ({READS})), c as (select x, f from (select distinct x from r where length(x) between 5 and 8 and regexp_full_match(x, '[a-z]+_[a-z]+')) cross join (select unnest([{quoted(vocab.FLAGS)}]) as f) where ends_with(f, x)),
          o as (select x, min(f) as flag from c group by x having count(*) = 1) select case_id, ord, fragment, flag from r join o on o.x = r.x where flag in ({quoted(vocab.DISQUALIFYING_FLAGS)})"""),
    ),
    "label_field_match": (
        lambda s, d: G.labelled_fields(reads(s, d).select("case_id", "ord", "line"), "line").where("field is not null").select("case_id", "ord", "field", "value"),
        oracle(("reads",), f"""with r as ({READS}), t as (select distinct line, lower(regexp_replace(regexp_extract(line, '^([^:]{{3,26}})[:.](.+)$', 1), '[\\s.]+', '', 'g')) as head, trim(regexp_extract(line, '^([^:]{{3,26}})[:.](.+)$', 2)) as value from r),
          c as (select line, head, value, label, field, i from t cross join (select unnest([{quoted(x for x, _ in G.LABELS)}]) as label, unnest([{quoted(y for _, y in G.LABELS)}]) as field, unnest(range({len(G.LABELS)})) as i) where length(head) >= 4),
          s as (select line, value, field, i, greatest({partial('label', 'head')}, {ratio('label', 'head')}) as s from c), b as (select line, any_value(value) as value, arg_max(field, s * 1000 - i) as field, max(s) as s from s group by line)
          select r.case_id, r.ord, b.field, b.value from r join b on b.line = r.line where s >= 78"""),
    ),
    "fee_presence": (
        lambda s, d: reads(s, d).groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_list("fee_status")), "").alias("corpus")).join(frame(s, d, "truth").select("case_id", "fee_status"), "case_id").select("case_id", G.present(F.col("fee_status"), F.col("corpus")).alias("present")),
        oracle(("reads", "truth"), """with c as (select case_id, array_to_string(list_sort(list(fee_status)), '') as corpus from reads group by case_id)
          select c.case_id, case when fee_status = 'paid' then len(regexp_extract_all(corpus, 'paid')) > len(regexp_extract_all(corpus, 'unpaid')) else contains(corpus, fee_status) end as present from c join truth on truth.case_id = c.case_id"""),
    ),
}

TRUE = ["home_world", "visa_class", "fee_status"]
KEYS = "select p_partkey, case p_partkey % 5 when 0 then concat('l/', p_brand) when 1 then concat('v/', p_brand, '/', p_name) when 2 then concat('v/', p_brand) when 3 then 'l/' else concat('v/', p_brand, '/a/', p_name) end as k from part"


def true_values(s, d):
    return frame(s, d, "truth").select("case_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("tgt")) for f in TRUE])).alias("x")).select("case_id", "x.*")


QUERIES |= {
    "pair_mining": (
        lambda s, d: G.mined_pairs(QUERIES["label_field_match"][0](s, d).select("case_id", "field", "value"), true_values(s, d)),
        oracle(("truth",), f"""with m as ({QUERIES['label_field_match'][1]}), t as (select case_id, unnest([{quoted(TRUE)}]) as field, unnest([{', '.join(TRUE)}]) as tgt from truth),
          p as (select m.field, lower(regexp_replace(value, '[\\s.]+', '', 'g')) = lower(regexp_replace(tgt, '[\\s.]+', '', 'g')) as same from m join t on t.case_id = m.case_id and t.field = m.field where tgt <> '')
          select field, count(*) as pairs, count(*) filter (where same) as clean, count(*) filter (where not same) as garbled from p group by field"""),
    ),
    "template_keys": (
        lambda s, d: given(s, d, KEYS).withColumn("x", G.template_key(F.col("k"))).where("x is not null").select("p_partkey", "x.kind", "x.label", "x.value"),
        f"""with k as (select *, string_split(k, '/') as w from ({KEYS})) select p_partkey, w[1] as kind, w[2] as label, case when w[1] = 'v' then array_to_string(w[3:], '/') end as value from k where (w[1] = 'l' and len(w) = 2 and w[2] <> '') or (w[1] = 'v' and len(w) >= 3 and w[2] <> '' and array_to_string(w[3:], '/') <> '')""",
    ),
}
