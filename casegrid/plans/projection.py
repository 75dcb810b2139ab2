"""Evidence views over the star-schema tables, in one SQL text for Spark and for DuckDB.

Each order is a case, and each of its lines a page of evidence that reads all nine fields; a second ledger repeats the
reads with other ranks and values. What differs between the two dialects goes through ``Dialect``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import vocab

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def days(self, start: str, end: str) -> str:
        return f"cast(datediff({end}, {start}) as int)" if self.spark else f"cast(date_diff('day', {start}, {end}) as int)"

    def minus_days(self, day: str, n: str) -> str:
        return f"date_sub({day}, {n})" if self.spark else f"cast({day} - ({n}) as date)"


SPARK, DUCKDB = Dialect("spark"), Dialect("duckdb")


def choice(expr: str, values: list[str]) -> str:
    """The value whose number is expr modulo their count."""
    return f"case {expr} % {len(values)} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


FIRST = ["Tekdane", "Oroxan", "Velmira", "Quoth", "Zanduin", "Ishtari", "Morwen", "Bexley"]
LAST = ["Ixovara", "Tolkane", "Ambrosh", "Drellin", "Vashtun", "Korrigan", "Nepthys"]
PAGES = ["note", "intake", "fee_receipt", "biometric", "sponsor_letter", "registry", "unknown"]


def views(d: Dialect) -> dict[str, str]:
    """Name -> SQL; a view may use those before it."""
    ship = d.days("date '1992-01-01'", "cast(l_shipdate as date)")
    ordered = d.days("date '1992-01-01'", "cast(o_orderdate as date)")
    arrival = f"""case when l_partkey % 37 = 5 then '2026-02-30'
        else cast({d.minus_days("date '2026-07-20'", f'{ship} % 240')} as string) end"""
    visa = "case when l_partkey % 5 = 4 then case when l_suppkey % 4 = 0 then 'TRANSIT-7' else 'MED-3' end else " + choice("l_partkey", ["DIP-1", "MED-3", "XW-1", "XW-2", "MED-3"]) + " end"
    fee = "case when l_returnflag = 'R' and l_suppkey % 3 = 0 then 'unpaid' when l_returnflag = 'A' and l_suppkey % 3 = 1 then 'waived' when l_linestatus = 'F' and l_suppkey % 5 = 2 then 'unknown' else 'paid' end"
    sponsor = "case when l_partkey % 29 = 0 then '' else concat('SPN-', lpad(cast(l_suppkey as string), 4, '0')) end"
    tax = "cast(round(l_tax * 100) as int)"
    flags = f"case {tax} when 6 then 'sponsor_mismatch' when 7 then 'identity_conflict|illegible_biometrics' when 8 then case when l_partkey % 3 = 0 then 'planetary_embargo' else 'illegible_biometrics' end else 'none' end"
    value = {
        "applicant_name": f"concat({choice('l_partkey', FIRST)}, ' ', {choice('l_suppkey', LAST)})",
        "species_code": choice("l_partkey", vocab.SPECIES),
        "home_world": choice("l_partkey", vocab.WORLDS),
        "visa_class": visa,
        "sponsor_id": sponsor,
        "arrival_date": arrival,
        "declared_purpose": choice("cast(round(l_discount * 100) as int)", vocab.PURPOSES),
        "risk_flags": flags,
        "fee_status": fee,
    }
    fallback = " ".join(f"when '{k}' then '{v}'" for k, v in vocab.FALLBACKS.items())
    fields = ", ".join(f"('{f}')" for f in vocab.FIELDS)
    each = f"case f.field {' '.join(f"when '{k}' then r.{k}" for k in vocab.FIELDS)} end as value"
    kind, weight = (choice("(l_linenumber - 1)", x) for x in (PAGES, [str(vocab.SOURCE_RANK[p]) for p in PAGES]))
    # Spark numbers lines while they are dealt by case_id, as what follows is, and makes the fields after that: rows are dealt
    # once, as lines. A line's place in its case is its place in the id less the lines of the orders before it. The fields
    # are made between the two windows, so that no generated method outgrows the 8000 bytes that the JVM compiles
    numbered = {
        "reads": f"""select case_id, case_no, l_partkey, l_suppkey, cast(n - rank() over (partition by case_id order by case_no) + 1 as int) as ord, source, rank, score, {', '.join(vocab.FIELDS)}
            from (select case_id, l_orderkey as case_no, l_partkey, l_suppkey, n, {kind} as source, cast({weight} as int) as rank, 60 + cast(l_quantity as int) % 40 as score, {', '.join(f'{v} as {k}' for k, v in value.items())}
              from (select *, row_number() over (partition by case_id order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as n
                from (select *, concat('MIB-', lpad(cast(l_orderkey as string), 6, '0')) as case_id from lineitem)))""",
    }
    # case_no and ord name one read, so Spark takes the second ledger from the read itself and not by a join of its candidates to it
    second = {
        "native_reads": f"""select case_id, case_no, ord, source, cast(least(6, rank + l_partkey % 3) as int) as rank, cast(score - 5 * (l_partkey % 3) as int) as score,
            {', '.join(f"case when l_suppkey % 7 = 0 then '{v}' else {k} end as {k}" for k, v in vocab.FALLBACKS.items())} from reads where l_partkey % 4 <> 1""",
        "native": f"select r.case_id, r.case_no, f.field, {each}, r.source, r.rank, r.score, r.ord from native_reads r cross join (values {fields}) as f(field)",
    }
    all_views = {
        "cases": f"""select concat('MIB-', lpad(cast(o_orderkey as string), 6, '0')) as case_id, o_orderkey as case_no, o_custkey as shard,
            {d.minus_days("date '2026-07-07'", f'{ordered} % 30')} as receipt_date, {d.minus_days("date '2026-07-15'", f'{ordered} % 45')} as created from orders""",
        "reads": f"""select concat('MIB-', lpad(cast(l_orderkey as string), 6, '0')) as case_id, l_orderkey as case_no, l_partkey, l_suppkey,
            cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as int) as ord,
            {choice('(l_linenumber - 1)', PAGES)} as source, cast({choice('(l_linenumber - 1)', [str(vocab.SOURCE_RANK[p]) for p in PAGES])} as int) as rank,
            60 + cast(l_quantity as int) % 40 as score, {', '.join(f'{v} as {k}' for k, v in value.items())} from lineitem""",
        "candidates": f"""select r.case_id, r.case_no, f.field, case f.field {' '.join(f"when '{k}' then r.{k}" for k in vocab.FIELDS)} end as value, r.source, r.rank, r.score, r.ord
            from reads r cross join (values {fields}) as f(field)""",
        "native": f"""select c.case_id, c.case_no, c.field, case when r.l_suppkey % 7 = 0 then case c.field {fallback} end else c.value end as value, c.source,
            cast(least(6, c.rank + r.l_partkey % 3) as int) as rank, cast(c.score - 5 * (r.l_partkey % 3) as int) as score, c.ord
            from candidates c join reads r on r.case_no = c.case_no and r.ord = c.ord where r.l_partkey % 4 <> 1""",
        "notes": """select case_id, ord as page, case when l_suppkey % 17 = 3 then 'APPROVED' when l_suppkey % 17 = 5 then 'DENIED' when l_suppkey % 17 = 9 then 'NEEDS_REVIEW' end as finding,
            cast(50 + l_partkey % 50 as int) as bio_confidence, case when l_partkey % 23 = 4 then 'HARDSHIP-12' when l_partkey % 23 = 9 then 'N/A' when l_partkey % 23 = 11 then 'DIP-WAIVER' end as waiver_code,
            case when l_suppkey % 13 = 2 then 'home_world' when l_suppkey % 13 = 4 then 'fee_status' end as absent_field, l_partkey % 31 = 7 as watermark, l_suppkey % 41 = 6 as registry_embargo,
            case when l_partkey % 19 = 3 then sponsor_id end as mined_sponsor, rank from reads where source in ('note', 'registry', 'biometric')""",
        "lines": f"""select r.case_id, r.ord as page, r.source, k.line_no, case k.line_no
              when 1 then case r.source when 'note' then 'ADJUDICATOR NOTE' when 'intake' then 'Intake Form' when 'fee_receipt' then 'FEE RECEIPT' when 'biometric' then 'Biometric Slip' when 'sponsor_letter' then 'Sponsor Letter' when 'registry' then 'Registry Extract' else 'Page' end
              when 2 then concat('Case ID: MIB-', lpad(cast(case when r.l_suppkey % 11 = 0 then r.case_no + 7 when r.l_suppkey % 11 = 5 then r.case_no + case when r.case_no % 10 = 9 then -1 else 1 end else r.case_no end as string), 6, '0'))
              when 3 then case r.l_suppkey % 4 when 0 then concat('Sponsor ID: ', r.sponsor_id) when 1 then concat('Sponsor ID: ', lower(replace(r.sponsor_id, '0', 'O'))) when 2 then concat('Sponsor ID:', replace(r.sponsor_id, '-', '. ')) else 'Sponsor ID:' end
              when 4 then case when r.l_suppkey % 4 = 3 then r.sponsor_id when r.l_partkey % 3 = 0 then concat('Arrival date: ', replace(r.arrival_date, '-', '/')) when r.l_partkey % 3 = 1 then concat('Arrival date ', replace(r.arrival_date, '-0', '-')) else concat('arrived ', r.arrival_date, '.') end
              when 5 then concat('Risk flags: ', replace(r.risk_flags, '|', case when r.l_partkey % 2 = 0 then ', ' else '; ' end))
              when 6 then case r.l_partkey % 9 when 0 then concat('Manual correction: fee status -> ', r.fee_status) when 1 then concat('FINDING: ', {choice('r.l_suppkey', ['APPROVED', 'DENIED', 'NEEDS REVIEW', 'not approved'])}) when 2 then 'DENIED'
                   when 3 then concat('Fee amount paid: $', cast(r.score as string), '.00') when 4 then 'Waiver code: HARDSHIP-42' when 5 then 'SAMPLE - ANSWER KEY' when 6 then 'VOID cancelled' when 7 then concat('The applicant ', r.applicant_name, ' of ', r.home_world, ' requests a ', r.visa_class, ' visa.') else concat('Manual correction: home world -> ', r.home_world, ' / none') end
              end as text, cast((70 + r.l_partkey % 30) as double) / 100 as conf
            from reads r cross join (values (1), (2), (3), (4), (5), (6)) as k(line_no)""",
        "struck": """select case_id, sponsor_id as token, case when l_partkey % 2 = 0 then 'global' else 'local' end as scope from reads where l_suppkey % 9 = 4 and sponsor_id <> ''
            union all select case_id, lower(home_world), 'global' from reads where l_partkey % 27 = 8""",
        "truth": f"""select o.case_id, {choice('c.o_custkey', vocab.WORLDS)} as home_world, {choice('c.o_custkey', vocab.VISAS)} as visa_class, {choice('c.o_custkey', vocab.FEES)} as fee_status,
            case c.o_orderpriority when '1-URGENT' then 'DENIED' when '2-HIGH' then 'NEEDS_REVIEW' else 'APPROVED' end as adjudication from cases o join orders c on c.o_orderkey = o.case_no""",
        "spans": """select l_orderkey as page, l_linenumber as seq0, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as int) * 2 as seq,
            cast(l_partkey % 400 as double) as x0, cast(l_suppkey % 600 as double) as y0, cast(l_partkey % 400 + 20 + l_quantity as double) as x1, cast(l_suppkey % 600 + 8 as double) as y1,
            case when l_quantity < 3 then 1.5 else 10.0 end as size, cast(l_discount * 10 as double) as channel, case when l_tax < 0.01 then 0.0 when l_tax < 0.02 then 0.1 else 1.0 end as opacity, cast(l_linenumber % 4 as int) as render_mode from lineitem""",
        "paint": """select l_orderkey as page, cast(row_number() over (partition by l_orderkey order by l_suppkey, l_partkey, l_linenumber, l_quantity, l_extendedprice) as int) * 2 + 1 as seq,
            cast(l_suppkey % 300 as double) as x0, cast(l_partkey % 500 as double) as y0, cast(l_suppkey % 300 + 200 as double) as x1, cast(l_partkey % 500 + 120 as double) as y1, cast(l_tax * 10 as double) as channel from lineitem where l_quantity > 20""",
        "attempts": f"""select e.user_id as shard, {choice('e.event_id', ['a', 'b', 'c'])} as kind, cast(e.event_id % 97 as bigint) as case_no, cast(row_number() over (partition by e.user_id, e.event_id % 97 order by e.ts, e.event_id) as int) as attempt,
            case when e.event_type = 'error' or e.event_id % 7 = 0 then 'failed' else 'ok' end as status,
            case e.event_id % 4 when 0 then 'TimeoutError: case took too long' when 1 then 'RuntimeError: session lost' when 2 then 'MemoryError' else 'ValueError: bad page' end as error, e.event_id, e.ts from events e""",
        "view_events": """select cast(event_id % 40 as int) as page, event_type as consumer, cast(user_id % 3 as int) as pass, cast(event_id % 2 as int) as transform, event_id, value from events""",
    }
    own = {"native": second, "reads": numbered} if d.spark else {}
    return {k: v for name, text in all_views.items() for k, v in own.get(name, {name: text}).items()}


def needed(names: tuple[str, ...], d: Dialect) -> dict[str, str]:
    """The named views and those they use, in order."""
    all_views = views(d)
    wanted = set(names)
    for name in reversed(list(all_views)):
        if name in wanted:
            wanted |= {v for v in all_views if v != name and re.search(rf"\b(?:from|join)\s+{v}\b", all_views[name])}
    return {k: v for k, v in all_views.items() if k in wanted}


def oracle(names: tuple[str, ...], query: str) -> str:
    """A DuckDB query over the views it names."""
    body = query.strip()
    parts = [f"{k} as ({v})" for k, v in needed(names, DUCKDB).items()]
    if body.lower().startswith("with "):
        body, parts = body[5:], [", ".join(parts) + ("," if parts else "")]
        return "with " + parts[0] + " " + body if parts[0] else query
    return ("with " + ", ".join(parts) + " " if parts else "") + body


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a DataFrame; nothing is registered in the session."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    wanted = needed((name,), SPARK)
    text = "with " + ", ".join(f"{k} as ({v})" for k, v in list(wanted.items())[:-1]) + " " + wanted[name] if len(wanted) > 1 else wanted[name]
    used = {t for t in TABLES if re.search(rf"\b(?:from|join)\s+{t}\b", text)}
    text = re.sub(rf"\b(from|join)\s+({'|'.join(sorted(used))})\b", r"\1 {\2}", text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})
