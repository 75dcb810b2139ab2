"""Queries over the forensics of pages and the admission of further readings, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import similarity as Y
from ..functions import text as X
from ..operators import admission as A
from ..operators import forensics as S
from .grammar import quoted
from .projection import frame, oracle
from .recovering import given

COLORS = "select l_orderkey as page, l_linenumber as line, cast(l_discount * 10 as double) as a, cast(l_tax * 10 as double) as b, cast(l_quantity / 100 as double) as c, 0.25e0 as d, cast(l_partkey % 4 as int) as kind from lineitem"
DASHES = "select l_orderkey as page, l_linenumber as line, case when l_partkey % 5 = 0 then concat('[', cast(cast(l_quantity as int) as string), '] 0') when l_partkey % 5 = 1 then concat(' [3 ', cast(l_linenumber as string), '] 1.5 ') when l_partkey % 5 = 2 then '[] 0' when l_partkey % 5 = 3 then '[0 0] 2' else '[1 x] 0' end as dash from lineitem"
NAMES = "select p_partkey, concat(replace(replace(p_name, ' ', '#20'), 'e', '#65'), case when p_partkey % 3 = 0 then '#4' when p_partkey % 3 = 1 then '##41' else '' end) as escaped from part"
SCANS = """select doc_id as page, doc_id % 97 = 3 as failed, cast(case when doc_id % 41 = 1 then 2 else 1 end as int) as images, doc_id % 43 = 2 as soft_mask, cast(case when doc_id % 47 = 3 then 1 else 8 end as int) as bits, case when doc_id % 53 = 4 then 'Indexed' else 'DeviceGray' end as colorspace,
  doc_id % 211 = 5 as referenced, doc_id % 59 = 5 as layers, cast(case when doc_id % 61 = 6 then 1 else 0 end as int) as decode_keys, doc_id % 67 = 7 as smask_in_data, case when doc_id % 71 = 8 then '' else 'FlateDecode' end as filters, doc_id % 73 = 9 as image_mask,
  cast(1240 + doc_id % 3 as int) as px_wide, cast(1754 as int) as px_high, cast(case when doc_id % 79 = 10 then 1 else 1240 + doc_id % 3 end as int) as dict_wide, cast(1754 as int) as dict_high, cast(8 as int) as dict_bits, doc_id % 83 = 11 as dict_error,
  case when doc_id % 89 = 12 then 2.0e0 else 1.0e0 end as user_unit, cast(case when doc_id % 37 = 13 then 1 else 0 end as int) as annotations, doc_id % 31 = 14 as clips, doc_id % 29 = 15 as odd_colors, doc_id % 101 = 16 as odd_fonts, doc_id % 103 <> 17 as bound, doc_id % 107 = 18 as odd_state,
  cast(case when doc_id % 109 = 19 then 0 else 1 end as int) as placements, case when doc_id % 113 = 20 then 0e0 when doc_id % 19 = 7 then 1240e0 when doc_id % 17 = 9 then 500e0 else 595e0 end as page_wide, case when doc_id % 19 = 7 then 1754e0 else 842e0 end as page_high,
  0e0 as x0, 0e0 as y0, case when doc_id % 127 = 21 then -1e0 when doc_id % 23 = 5 then 300e0 when doc_id % 19 = 7 then 1240e0 when doc_id % 17 = 9 then 500e0 else 595e0 end as x1, case when doc_id % 19 = 7 then 1754e0 else 842e0 end as y1, cast(case when doc_id % 131 = 22 then 45 when doc_id % 11 = 4 then 180 else 0 end as int) as rotation,
  cast(case when doc_id % 13 = 6 then 1 else 0 end as int) as overlays from documents"""
OUTCOME = """case when failed then 'inspection_exception' when images <> 1 then 'image_count_not_one' when soft_mask or bits <> 8 or colorspace not in ('DeviceGray', 'DeviceRGB') or referenced then 'image_tuple_unsupported' when layers then 'optional_content' when decode_keys > 0 then 'image_decode_ambiguity'
  when smask_in_data then 'smask_in_data' when filters = '' then 'image_filter_mismatch' when image_mask then 'image_mask' when dict_wide <> px_wide or dict_high <> px_high or dict_bits <> 8 then 'image_dictionary_metadata_mismatch' when dict_error then 'image_dictionary_inspection_error' when user_unit <> 1 then 'nondefault_user_unit'
  when annotations > 0 then 'annotations_or_widgets' when clips then 'clipping_or_text_clip' when odd_colors then 'unsafe_color_context' when odd_fonts then 'unsafe_font_context' when not bound then 'target_image_binding_mismatch' when odd_state then 'unsafe_graphics_state' when placements <> 1 then 'placement_count_not_one'
  when page_wide <= 0 or page_high <= 0 then 'invalid_cropbox' when x1 <= x0 or y1 <= y0 then 'invalid_placement_rect' when abs(x0) > 1e-4 or abs(y0) > 1e-4 or abs(x1 - page_wide) > 1e-4 or abs(y1 - page_high) > 1e-4 then 'not_full_bleed' when rotation not in (0, 90, 180, 270) then 'ambiguous_transform'
  when least(case when rotation in (90, 270) then px_high else px_wide end / page_wide, case when rotation in (90, 270) then px_wide else px_high end / page_high) < 1.5e0 then 'insufficient_resolution'
  when abs(case when rotation in (90, 270) then px_high else px_wide end * page_high / (case when rotation in (90, 270) then px_wide else px_high end * page_wide) - 1) > 0.02e0 then 'aspect_ratio_mismatch' when overlays > 0 then 'evidence_bearing_overlay' else 'eligible' end"""
PAGES = "select o_orderkey as page, o_orderkey % 13 <> 1 as paint_valid, o_orderkey % 17 <> 2 as drawings_valid, o_orderkey % 19 = 3 as clips, o_orderkey % 23 = 4 as transparency, o_orderkey % 29 = 5 as odd_fonts, 380e0 as width, 560e0 as height from orders"
COVERS = "select page, seq, case cast(x0 as int) % 4 when 0 then 'image' when 1 then 'text' when 2 then 'stroke' else 'fill' end as kind, cast(y0 as int) % 3 > 0 as simple, channel, x0, y0, x1, y1 from paint"
TEXT = "select page, seq, case when seq % 10 = 4 then null else seq end as paint_seq, x0, y0, x1, y1, size, channel, opacity, render_mode from spans"
PIXELS = "select case_id, field, value, cast(score as double) / 130 as ncc, cast(100 - score as double) / 200 as margin, score % 3 > 0 as confirmed from candidates where ord = 1 and value <> ''"
FEES = """select l_orderkey as page, l_linenumber as line, case when l_partkey % 3 = 0 then 'fee_receipt' when l_partkey % 3 = 1 then 'unknown' else 'intake' end as page_type, cast(l_suppkey % 40 as double) / 50 + 0.2e0 as label, cast(case when l_suppkey % 11 = 0 then 1 else 0 end as int) as stamps,
  cast(l_partkey % 50 as double) / 100 + 0.5e0 as paid, cast(l_partkey % 15 as int) as paid_x, cast(l_suppkey % 30 as double) / 10 as ink, cast(l_partkey % 40 as double) / 60 as unpaid, cast(l_suppkey % 60 as double) / 100 as waived, cast(l_suppkey % 50 as double) / 100 as unknown,
  cast(l_partkey % 50 as double) / 100 + 0.5e0 - cast(l_suppkey % 3 as double) / 20 as paid_head, case when l_partkey % 17 = 0 then 'paid' when l_partkey % 19 = 0 then 'unpaid' else '' end as struck from lineitem"""
WORLDS = "select case_id, ord, home_world as world, cast(score as double) / 120 as raw, cast(score as double) / 125 as stretched, cast(l_partkey % 25 as int) as raw_x, cast(l_suppkey % 24 as int) as stretched_x from reads"
PROPOSALS = """select case_id, ord, field, value, rank, score, case field when 'home_world' then 'Luyten-b' when 'visa_class' then case when ord % 2 = 0 then 'TRANSIT-7' else 'XW-1' end when 'fee_status' then 'paid' when 'sponsor_id' then 'SPN-0007' else value end as proposal, 0e0 - cast(score % 50 as double) / 100 as logprob from candidates"""
BLOCKS = "select case_id, cast(case_no % 3 as int) as guards, case_no % 5 = 0 as sponsor_blocked, case_no % 7 = 0 as embargo, case when case_no % 4 = 0 then 'arrival_date' when case_no % 4 = 1 then 'sponsor_id,fee_status' else '' end as absent, case_no % 2 = 0 as exempt from cases"
DENIES = f"((field = 'visa_class' and {{0}} = 'TRANSIT-7') or (field = 'home_world' and {{0}} in ({quoted(vocab.SOFT_EMBARGO_WORLDS + vocab.HARD_EMBARGO_WORLDS)})) or (field = 'fee_status' and {{0}} = 'unpaid') or (field = 'sponsor_id' and {{0}} in ({quoted(vocab.REVOKED_SPONSORS)})))"
CELLS = "select p_partkey, case when p_partkey % 3 = 0 then concat(p_name, ', b,c,d,e,f,g,h,i,j, APPROVED') else concat(p_name, ',', p_type) end as line from part"
ODD = "select p_partkey, case p_partkey % 5 when 0 then cast(p_size as string) when 1 then 'nan' when 2 then 'none' when 3 then '1e999' else concat('-', cast(p_size as string), '.5') end as x from part"


def colors(s, d):
    kinds = F.when(F.col("kind") == 0, F.array("a")).when(F.col("kind") == 1, F.array("a", "b", "c")).when(F.col("kind") == 2, F.array("a", "b", "c", "d")).otherwise(F.array("a", "b"))
    return given(s, d, COLORS).withColumn("color", kinds).withColumn("rgb", S.rgb(F.col("color")))


def scans(s, d):
    return given(s, d, SCANS).select("page", S.scan_outcome().alias("outcome"))


def fields_of(s, d):
    return frame(s, d, "candidates").where("ord > 1 and value <> ''").select("case_id", "field")


def blocked(s, d):
    rows = given(s, d, BLOCKS).withColumn("absent", F.split("absent", ","))
    return rows.select("case_id", A.preserved_blocker(*[F.col(x) for x in ("guards", "sponsor_blocked", "embargo", "absent", "exempt")]).alias("blocked"))


def proposals(s, d):
    rows = given(s, d, PROPOSALS).withColumn("c", A.corrected(*[F.col(x) for x in ("value", "field", "rank", "score", "proposal", "logprob")]))
    return rows.where("c.corrected").select("case_id", "ord", "field", F.col("c.value").alias("value"), "c.score")


QUERIES = {
    "color_normalised": (
        lambda s, d: colors(s, d).select("page", "line", "kind", F.round(F.col("rgb")[0], 6).alias("red"), F.round(F.col("rgb")[1], 6).alias("green"), F.round(F.col("rgb")[2], 6).alias("blue"), S.same_paint(F.col("color"), F.array(F.lit(0.5))).alias("grey")),
        f"""with k as ({COLORS}), r as (select page, line, kind, case kind when 0 then [a, a, a] when 1 then [a, b, c] when 2 then [1 - least(1e0, a + d), 1 - least(1e0, b + d), 1 - least(1e0, c + d)] end as v from k)
          select page, line, kind, round(v[1], 6) as red, round(v[2], 6) as green, round(v[3], 6) as blue, coalesce(abs(v[1] - 0.5e0) <= 1e-3 and abs(v[2] - 0.5e0) <= 1e-3 and abs(v[3] - 0.5e0) <= 1e-3, false) as grey from r""",
    ),
    "dash_patterns": (
        lambda s, d: given(s, d, DASHES).withColumn("x", S.dash(F.col("dash"))).where("x is not null").select("page", "line", F.size("x.pattern").cast("int").alias("parts"), F.aggregate("x.pattern", F.lit(0.0), lambda a, b: a + b).alias("length"), "x.phase"),
        f"""with k as ({DASHES}), p as (select page, line, list_transform(list_filter(regexp_split_to_array(regexp_extract(trim(dash), '^\\[([^\\]]*)\\]\\s+([0-9.]+)$', 1), '\\s+'), lambda x: x <> ''), lambda x: try_cast(x as double)) as parts, try_cast(regexp_extract(trim(dash), '^\\[([^\\]]*)\\]\\s+([0-9.]+)$', 2) as double) as phase from k),
          q as (select *, len(parts) * case when len(parts) % 2 = 1 then 2 else 1 end as n, coalesce(list_sum(parts), 0e0) * case when len(parts) % 2 = 1 then 2 else 1 end as total from p where len(list_filter(parts, lambda x: x is null)) = 0) select page, line, cast(n as int) as parts, total as length, phase from q where n = 0 or total > 0""",
    ),
    "name_escapes": (
        lambda s, d: given(s, d, NAMES).select("p_partkey", S.unescaped(F.col("escaped")).alias("name")),
        "select p_partkey, concat(p_name, case when p_partkey % 3 = 0 then '#4' when p_partkey % 3 = 1 then '#A' else '' end) as name from part",
    ),
    "native_authorisation": (scans, f"select page, {OUTCOME} as outcome from ({SCANS})"),
    "native_outcome_census": (
        lambda s, d: S.outcome_census(scans(s, d)),
        f"with o as (select {OUTCOME} as outcome, count(*) as n from ({SCANS}) group by all) select cast(i as int) as rung, k.outcome, coalesce(n, 0) as n from (select unnest([{quoted(S.OUTCOMES)}]) as outcome, unnest(range({len(S.OUTCOMES)})) as i) k left join o on o.outcome = k.outcome",
    ),
    "span_reasons": (
        lambda s, d: S.span_reasons(given(s, d, TEXT), given(s, d, PAGES), given(s, d, COVERS)),
        oracle(("spans", "paint"), f"""with t as ({TEXT}), p as ({PAGES}), v as ({COVERS}),
          j as (select t.page, t.seq, t.paint_seq, t.channel as ink, v.seq as vseq, kind, simple, v.channel as paint, greatest(least(t.x1, v.x1) - greatest(t.x0, v.x0), 0e0) * greatest(least(t.y1, v.y1) - greatest(t.y0, v.y0), 0e0) >= 0.6e0 * (t.x1 - t.x0) * (t.y1 - t.y0) as hides, v.x0 <= t.x0 and v.y0 <= t.y0 and v.x1 >= t.x1 and v.y1 >= t.y1 as holds from t join v on v.page = t.page),
          m as (select page, seq, bool_or(vseq > paint_seq and hides and kind = 'image') as image, bool_or(vseq > paint_seq and hides and kind = 'text') as text, bool_or(vseq > paint_seq and hides and kind = 'stroke') as stroke, bool_or(vseq > paint_seq and hides and kind = 'fill' and simple) as fill, bool_or(paint_seq is null and hides) as unordered,
            arg_max(simple and abs(paint - ink) <= 1e-3, vseq) filter (where vseq < paint_seq and holds and kind in ('fill', 'image')) as same from j group by page, seq)
          select t.page, t.seq, array_to_string(list_filter([case when not paint_valid then 'paint_inventory_ambiguous' end, case when not drawings_valid then 'drawing_inventory_ambiguous' end, case when clips then 'unresolved_clip_state' end, case when transparency then 'unresolved_transparency' end, case when odd_fonts then 'untrusted_font_context' end,
            case when opacity = 0 then 'opacity0' end, case when opacity > 0 and opacity < 0.18e0 - 1e-6 then 'low_opacity' end, case when render_mode > 1 then 'invisible_render_mode' end, case when t.channel >= 0.97e0 then 'white_text' end, case when t.x0 < -1e-3 or t.y0 < -1e-3 or t.x1 > width + 1e-3 or t.y1 > height + 1e-3 then 'off_crop' end, case when size < 2.5e0 then 'microtext' end,
            case when image then 'under_image' end, case when text then 'under_text' end, case when fill then 'under_fill' end, case when same then 'no_visible_color_contrast' end, case when stroke then 'under_stroke' end, case when unordered then 'paint_order_ambiguous' end], lambda x: x is not null), ',') as reasons
          from t join p on p.page = t.page left join m on m.page = t.page and m.seq = t.seq"""),
    ),
    "pixel_admission": (
        lambda s, d: A.pixel_reads(given(s, d, PIXELS), fields_of(s, d), frame(s, d, "struck"), frame(s, d, "notes").where("absent_field is not null").select("case_id", F.col("absent_field").alias("field"))),
        oracle(("candidates", "struck", "notes"), f"""with r as ({PIXELS}), g as (select * from r where (field = 'species_code' and ncc >= 0.45e0 and margin >= 0.08e0) or (field = 'home_world' and ncc >= 0.55e0 and margin >= 0.12e0))
          select case_id, field, value, cast(6 as int) as rank, 60 + least(30e0, 200 * margin) as score from g where not exists (select 1 from candidates c where c.case_id = g.case_id and c.field = g.field and ord > 1 and value <> '')
          and not exists (select 1 from notes n where n.case_id = g.case_id and n.absent_field = g.field) and not exists (select 1 from struck s where s.case_id = g.case_id and lower(s.token) = lower(g.value))"""),
    ),
    "fee_classifier": (
        lambda s, d: given(s, d, FEES).select("page", "line", A.fee_read().alias("fee")).where("fee is not null"),
        f"""with f as ({FEES}), k as (select *, (page_type = 'fee_receipt' or (page_type = 'unknown' and label >= 0.8e0)) and stamps = 0 as receipt, case when page_type = 'unknown' then 0.7e0 else 0.6e0 end as floor from f),
          r as (select page, line, case when receipt and struck <> 'unpaid' and paid >= 0.82e0 and paid_x between 8 and 13 and ink >= 1.5e0 and unpaid >= 0.5e0 and paid - waived >= 0.12e0 and paid > unknown and paid_head <= paid - 0.05e0 then 'unpaid'
            when receipt and struck <> 'paid' and paid >= floor and paid_x <= 6 and ink <= 1.5e0 and paid_head >= floor - 0.02e0 and paid - greatest(waived, unknown, unpaid) >= 0.06e0 then 'paid' end as fee from k) select * from r where fee is not null""",
    ),
    "world_two_views": (
        lambda s, d: given(s, d, WORLDS).withColumn("w", A.world_read(*[F.col(x) for x in ("world", "raw", "stretched", "raw_x", "stretched_x")])).where("w is not null").select("case_id", "ord", "w.value", "w.score"),
        oracle(("reads",), f"with w as ({WORLDS}) select case_id, ord, world as value, round(least(92e0, 70 + raw * 30), 1) as score from w where world in ({quoted(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS)}) and raw >= 0.5e0 and stretched >= 0.5e0 and raw_x <= 20 and stretched_x <= 20"),
    ),
    "transducer_replacement": (
        proposals,
        oracle(("candidates",), f"""with p as ({PROPOSALS}) select case_id, ord, field, proposal as value, greatest(cast(score as double), 80e0) as score from p where rank > 1 and score < 88 and ((field in ('species_code', 'home_world', 'visa_class', 'declared_purpose') and logprob >= -0.3e0) or (field = 'arrival_date' and logprob >= -0.1e0))
          and proposal <> value and not ({DENIES.format('value')} and not {DENIES.format('proposal')})"""),
    ),
    "deny_triggers": (
        lambda s, d: frame(s, d, "candidates").where(A.triggers_denial(F.col("field"), F.col("value"))).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")),
        oracle(("candidates",), f"select field, value, count(*) as n from candidates where {DENIES.format('value')} group by all"),
    ),
    "preserved_blockers": (
        blocked,
        oracle(("cases",), f"with b as ({BLOCKS}) select case_id, guards > 0 or sponsor_blocked or embargo or list_contains(string_split(absent, ','), 'arrival_date') or (list_contains(string_split(absent, ','), 'sponsor_id') and not exempt) as blocked from b"),
    ),
    "finite_numbers": (
        lambda s, d: given(s, d, ODD).select("p_partkey", X.number(F.col("x"), -1.0).alias("number")),
        f"with o as ({ODD}) select p_partkey, case when x is null or try_cast(x as double) is null or isnan(try_cast(x as double)) or isinf(try_cast(x as double)) then -1e0 else try_cast(x as double) end as number from o",
    ),
    "answer_key_cells": (
        lambda s, d: given(s, d, CELLS).withColumn("k", X.answer_key(F.col("line"))).where("k is not null").select("p_partkey", "k.verdict"),
        f"with c as (select p_partkey, string_split(line, ',') as cells from ({CELLS})) select p_partkey, trim(cells[11]) as verdict from c where len(cells) = 11",
    ),
    "document_dates": (
        lambda s, d: frame(s, d, "orders").select("o_orderkey", X.pdf_date(F.concat(F.lit("D:"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("120000Z"))).alias("day"), X.digits_read(F.concat(F.lit("SPN-OL"), (F.col("o_custkey") % 10).cast("string"), F.lit("B"))).alias("sponsor")),
        "select o_orderkey, cast(o_orderdate as date) as day, concat('SPN-01', cast(o_custkey % 10 as varchar), '8') as sponsor from orders",
    ),
    "sequence_similarity": (lambda s, d: frame(s, d, "part").select("p_partkey", Y.sequence_ratio(F.col("p_name"), F.col("p_type")).alias("score")), None),
}
