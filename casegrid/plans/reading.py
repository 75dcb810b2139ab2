"""Queries over page lines and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import text as X
from ..operators import pages as R
from .projection import frame, oracle

COMPACT = "lower(regexp_replace(text, '[\\s.]+', '', 'g'))"
TYPE = "case " + " ".join(f"when contains({COMPACT}, '{t.lower().replace(' ', '')}') then {k}" for k, (_, t) in enumerate(X.TITLES)) + " end"
NAMES = "case min(t) " + " ".join(f"when {k} then '{n}'" for k, (n, _) in enumerate(X.TITLES)) + " else 'unknown' end"
TYPES = f"types as (select case_id, page, {NAMES} as page_type from (select case_id, page, {TYPE} as t from lines where line_no <= 8) group by all)"
IDS = "ids as (select case_id, page, unnest(regexp_extract_all(text, 'MIB-\\d{6}')) as id from lines)"
MARK = "regexp_matches(text, '(?i)\\b(sample|answer\\s*key|specimen|training copy)\\b')"
FLAGS = ", ".join(f"'{f}'" for f in vocab.FLAGS)
FIELDS = ", ".join(f"'{f}'" for f in vocab.FIELDS)
STAMPS = " or ".join(f"contains(upper(text), '{x}')" for x in X.CANCEL_STAMPS)


def lines(spark, sf_dir):
    return frame(spark, sf_dir, "lines")


def sql(query: str) -> str:
    return oracle(("lines",), query)


QUERIES = {
    "case_id_resolution": (
        lambda s, d: R.resolved_ids(lines(s, d)),
        sql(f"""with {IDS}, votes as (select case_id, id, count(distinct page) as pages from ids group by all), best as (select *, row_number() over (partition by case_id order by pages desc, id) as n from votes)
          select l.case_id, l.case_id as resolved, 'name' as how, b.id as voted from (select distinct case_id from lines) l left join best b on b.case_id = l.case_id and b.n = 1"""),
    ),
    "foreign_page_filter": (
        lambda s, d: R.foreign_pages(lines(s, d)).where("foreign").select("case_id", "page"),
        sql(f"with {IDS} select distinct case_id, page from ids where length(id) <> length(case_id) or hamming(id, case_id) > 1"),
    ),
    "page_binding_class": (
        lambda s, d: R.page_binding(lines(s, d)),
        sql(f"""with {IDS}, o as (select case_id, page, bool_or(id <> case_id) as other from ids group by all), m as (select case_id, page, bool_or({MARK}) as marked from lines group by all)
          select m.case_id, m.page, case when marked or coalesce(other, false) then 'unsafe' when other is not null then 'active_only' else 'neutral' end as binding from m left join o on o.case_id = m.case_id and o.page = m.page"""),
    ),
    "page_type_header_window": (lambda s, d: R.page_types(lines(s, d)), sql(f"with {TYPES} select * from types")),
    "label_neighbour_values": (
        lambda s, d: R.neighbour_values(lines(s, d), "Sponsor ID"),
        sql("""with a as (select case_id, page, line_no, text, lead(text) over w as below, lag(text) over w as above from lines window w as (partition by case_id, page order by line_no)),
          b as (select *, regexp_extract(text, '(?i)^\\s*Sponsor ID\\s*[:\\-]?\\s*(.*?)\\s*$', 1) as own from a where regexp_matches(text, '(?i)^\\s*Sponsor ID'))
          select case_id, page, line_no, case when own <> '' then own else coalesce(case when trim(below) <> '' then below end, above) end as value from b"""),
    ),
    "letter_sentence_extract": (
        lambda s, d: lines(s, d).withColumn("l", X.letter(F.col("text"))).where("l is not null").groupBy("case_id").agg(F.min_by("l", "page").alias("l")).select("case_id", "l.name", "l.world", "l.visa"),
        sql("""with m as (select case_id, page, regexp_extract(text, '^The applicant (\\w+ \\w+) of (.+) requests a ([A-Z]+-\\d) visa\\.$', ['name', 'world', 'visa']) as l from lines where text like 'The applicant %')
          select case_id, l.name as name, l.world as world, l.visa as visa from (select case_id, arg_min(l, page) as l from m where l.name <> '' group by all)"""),
    ),
    "sponsor_repair": (
        lambda s, d: R.neighbour_values(lines(s, d), "Sponsor ID").select("case_id", "page", X.sponsor_repaired(F.col("value")).alias("sponsor_id")).where("sponsor_id is not null"),
        sql("""with a as (select case_id, page, line_no, text, lead(text) over w as below, lag(text) over w as above from lines window w as (partition by case_id, page order by line_no)),
          b as (select *, regexp_extract(text, '(?i)^\\s*Sponsor ID\\s*[:\\-]?\\s*(.*?)\\s*$', 1) as own from a where regexp_matches(text, '(?i)^\\s*Sponsor ID')),
          v as (select case_id, page, case when own <> '' then own else coalesce(case when trim(below) <> '' then below end, above) end as value from b),
          x as (select case_id, page, regexp_extract(replace(translate(upper(regexp_replace(value, '\\s+', '', 'g')), 'O', '0'), 'SPN.', 'SPN-'), 'SPN-\\d{4}') as sponsor_id from v)
          select * from x where sponsor_id <> ''"""),
    ),
    "date_repair": (
        lambda s, d: lines(s, d).where(F.col("text").rlike("(?i)^arriv")).withColumn("r", X.date_repaired(F.col("text"))).where("r is not null").select("case_id", "page", "r.value", "r.score"),
        sql("""with a as (select case_id, page, regexp_extract(text, '\\d{4}-\\d{2}-\\d{2}') as strict, regexp_extract(text, '(\\d{4})[-/. ]+(\\d{1,2})[-/. ]+(\\d{1,2})', ['y', 'm', 'd']) as p from lines where regexp_matches(text, '(?i)^arriv')),
          b as (select *, concat_ws('-', p.y, lpad(p.m, 2, '0'), lpad(p.d, 2, '0')) as loose from a)
          select case_id, page, case when ok then strict else loose end as value, cast(case when ok then 90 else 80 end as int) as score from (select *, strict <> '' and try_cast(strict as date) is not null as ok from b)
          where ok or (p.y <> '' and try_cast(loose as date) is not null)"""),
    ),
    "flag_list_parse": (
        lambda s, d: lines(s, d).withColumn("v", X.labelled(F.col("text"), "Risk flags")).where("v is not null").select("case_id", "page", X.flags_parsed(F.col("v")).alias("p")).select("case_id", "page", "p.value", "p.score"),
        sql(f"""with a as (select case_id, page, list_transform(regexp_split_to_array(lower(regexp_extract(text, '(?i)^\\s*Risk flags\\s*[:\\-]?\\s*(.*?)\\s*$', 1)), '[|,;]+'), lambda x: trim(x)) as parts from lines where regexp_matches(text, '(?i)^\\s*Risk flags')),
          b as (select *, list_filter(parts, lambda x: x in ({FLAGS})) as known, len(list_filter(parts, lambda x: x not in ('none', 'n/a', 'nil', ''))) > 0 as content from a)
          select case_id, page, case when len(known) = 0 then 'none' else array_to_string(list_sort(list_distinct(known)), '|') end as value, cast(case when len(known) > 0 then 90 when content then 40 else 90 end as int) as score from b"""),
    ),
    "manual_corrections": (
        lambda s, d: lines(s, d).withColumn("c", X.correction(F.col("text"))).where("c is not null").select("case_id", "page", "c.field", "c.value"),
        sql(f"""with a as (select case_id, page, replace(lower(regexp_extract(text, '(?i)^manual correction:\\s*([a-z ]+?)\\s*->\\s*(.*?)\\s*$', 1)), ' ', '_') as field, regexp_extract(text, '(?i)^manual correction:\\s*([a-z ]+?)\\s*->\\s*(.*?)\\s*$', 2) as value from lines)
          select * from a where field in ({FIELDS}) and not contains(value, '/') and value <> '' and not regexp_matches(lower(value), '^[^a-z0-9]*(no|not|never)([^a-z0-9]|$)')"""),
    ),
    "finding_grammar": (
        lambda s, d: R.findings(lines(s, d)),
        sql("""with a as (select case_id, page, line_no, regexp_matches(text, '(?i)^finding\\s*:') as lab, replace(upper(regexp_extract(text, '(?i)^finding\\s*:\\s*(.*?)\\s*$', 1)), ' ', '_') as given, text from lines),
          b as (select case_id, page, line_no, lab, case when lab then case when given in ('APPROVED', 'DENIED', 'NEEDS_REVIEW') then given end else replace(text, ' ', '_') end as v from a where lab or text in ('APPROVED', 'DENIED', 'NEEDS REVIEW')),
          c as (select case_id, page, max(case when lab then line_no end) as at from b group by all)
          select c.case_id, c.page, coalesce(max(case when b.line_no = c.at then v end), arg_min(case when b.line_no > coalesce(c.at, -1) then v end, case when b.line_no > coalesce(c.at, -1) then b.line_no end)) as finding
          from c join b on b.case_id = c.case_id and b.page = c.page group by c.case_id, c.page"""),
    ),
    "signed_reasons": (
        lambda s, d: R.trusted(lines(s, d)).where(F.col("text").rlike("(?i)^risk flags")).select("case_id", "page", F.explode(X.flag_set(X.flags_parsed(F.regexp_extract("text", r"(?i)^risk flags:?\s*(.*)$", 1))["value"])).alias("flag")).groupBy("case_id", "flag").agg(F.count(F.lit(1)).alias("n")),
        sql(f"""with w as (select *, max(case when {MARK} then 1 else 0 end) over (partition by case_id, page order by line_no rows between unbounded preceding and current row) as mark from lines),
          a as (select case_id, page, unnest(list_distinct(list_filter(list_transform(regexp_split_to_array(lower(regexp_extract(text, '(?i)^risk flags:?\\s*(.*)$', 1)), '[|,;]+'), lambda x: trim(x)), lambda x: x in ({FLAGS})))) as flag from w where mark = 0 and regexp_matches(text, '(?i)^risk flags'))
          select case_id, flag, count(*) as n from a group by all"""),
    ),
    "paid_amount_indicator": (
        lambda s, d: R.paid_pages(lines(s, d)),
        sql(f"""with {TYPES}, f as (select case_id, page, bool_or(regexp_matches(text, '(?i)(^|[^A-Za-z0-9])amount\\s+paid:?\\s*\\$?\\d+(\\.\\d\\d)?([^A-Za-z0-9]|$)')) as paid, bool_or(regexp_matches(text, '(?i)^fee status')) as direct, bool_or({STAMPS}) as void from lines group by all)
          select f.case_id, f.page from f join types t on t.case_id = f.case_id and t.page = f.page where t.page_type = 'fee_receipt' and paid and not direct and not void"""),
    ),
    "cancel_stamps": (
        lambda s, d: lines(s, d).withColumn("stamps", F.array_join(X.cancel_stamps(F.col("text")), ",")).where("stamps <> ''").select("case_id", "page", "line_no", "stamps"),
        sql("select case_id, page, line_no, array_to_string(list_filter([" + ", ".join(f"'{x}'" for x in X.CANCEL_STAMPS) + f"], lambda x: contains(upper(text), x)), ',') as stamps from lines where {STAMPS}"),
    ),
    "strike_tokens": (
        lambda s, d: frame(s, d, "part").select("p_partkey", F.array_join(X.tokens(F.col("p_name")), " ").alias("tokens")),
        "select p_partkey, array_to_string(list_transform(regexp_extract_all(p_name, '[A-Za-z0-9]+(?:[-_|][A-Za-z0-9]+)*'), lambda x: lower(x)), ' ') as tokens from part",
    ),
    "text_sanitise": (lambda s, d: frame(s, d, "documents").select("doc_id", F.sha2(X.sanitized(X.nfkc(F.col("text"))).cast("binary"), 256).alias("digest")), None),
    "error_census": (
        lambda s, d: frame(s, d, "attempts").where("status = 'failed'").groupBy(X.failure_category(F.col("error")).alias("category"), X.error_tail(F.col("error"), 12).alias("tail")).agg(F.count(F.lit(1)).alias("n")),
        oracle(("attempts",), "select case when contains(error, 'Timeout') then 'timeout' when contains(error, 'session') then 'session' when contains(error, 'Memory') then 'memory' else 'other' end as category, right(error, 12) as tail, count(*) as n from attempts where status = 'failed' group by all"),
    ),
    "holdout_split": (
        lambda s, d: frame(s, d, "cases").select("case_id", X.md5_modulo(F.col("case_id"), 5).cast("int").alias("fold"), X.md5_modulo(F.col("case_id"), 2).cast("int").alias("half")),
        oracle(("cases",), "select case_id, cast(list_sum(list_transform(string_split(md5(case_id), ''), lambda c: instr('0123456789abcdef', c) - 1)) % 5 as int) as fold, cast((instr('0123456789abcdef', right(md5(case_id), 1)) - 1) % 2 as int) as half from cases"),
    ),
    "subsample": (
        lambda s, d: frame(s, d, "cases").orderBy(F.md5(F.concat(F.lit("7:"), F.col("case_id")).cast("binary")), "case_id").limit(50).select("case_id"),
        oracle(("cases",), "select case_id from cases order by md5(concat('7:', case_id)), case_id limit 50"),
    ),
}
