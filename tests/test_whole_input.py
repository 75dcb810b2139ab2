"""Queries that must take their whole input, held against counts and SQL of this file's own."""

import hashlib
import random

import duckdb
import pytest

from casegrid import catalogue, vocab
from casegrid.config import EngineConfig
from casegrid.operators import supervise
from casegrid.plans.projection import TABLES, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def got(spark, name, *columns):
    return sorted(map(tuple, catalogue.queries()[name](spark, SF).select(*columns).collect()), key=str)


def want(duck, sql):
    return sorted(duck.execute(sql).fetchall(), key=str)


def test_every_case_of_the_manifest_gets_a_state(spark, duck):
    first = "select case_no, arg_min(status, event_id) as status, arg_min(error, event_id) as error from attempts group by case_no"
    whole = want(duck, oracle(("cases", "attempts"), f"with f as ({first}) select c.case_id, coalesce(f.status, 'missing'), f.error from cases c left join f on f.case_no = c.case_no"))
    assert got(spark, "state_merge_backfill", "case_id", "status", "error") == whole and len(whole) == 1500


def test_every_document_is_scheduled(spark, tmp_path):
    """More documents than any fixed cap, ties in length, several parts and an empty table."""
    rows = [(i, None if i == 7 else "x" * (i * 37 % 50), i * 37 % 50) for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.queries()["packet_schedule"](spark, str(tmp_path)).select("doc_id", "n_chars", "sha256", "ordinal").collect()
    order = sorted((n, i) for i, _, n in rows)
    assert sorted((r["ordinal"], r["n_chars"], r["doc_id"]) for r in found) == [(k + 1, n, i) for k, (n, i) in enumerate(order)]
    assert all(r["sha256"] == (None if rows[r["doc_id"]][1] is None else hashlib.sha256(rows[r["doc_id"]][1].encode()).hexdigest()) for r in found)
    assert supervise.scheduled(docs.limit(0), ["n_chars", "doc_id"]).count() == 0


def by_hand(ratios, config=EngineConfig()):
    level, out = 0, []
    for x in ratios:
        up = sum(x >= t for t in config.governor_up)
        level = up if up > level else level - 1 if level and x < config.governor_down[level - 1] else level
        out.append(level)
    return out


def test_every_event_moves_the_governor(spark, duck):
    sql = "select user_id % 10, event_id, cast(round(0.9 + (value - floor(value / 10) * 10) / 10, 4) as double) from events order by 1, 2, 3"
    ticks = duck.execute(sql).fetchall()
    whole = [(b, n, x, level) for batch in sorted({t[0] for t in ticks}) for (b, n, x), level in zip([t for t in ticks if t[0] == batch], by_hand([t[2] for t in ticks if t[0] == batch]), strict=True)]
    assert len(whole) == 1000 and got(spark, "governor_levels", "batch_id", "completed", "ratio", "level") == sorted(whole, key=str)


@pytest.mark.parametrize("parts", ["1", "7", "60"])
def test_levels_go_on_across_parts(spark, parts):
    """One batch over many parts, parts with many batches, a null batch, and no ticks."""
    r = random.Random(3)
    rows = [(b, n, round(r.uniform(0.85, 1.8), 2)) for b, most in ((1, 400), (2, 1), (3, 1), (None, 90), (4, 30)) for n in range(most)]
    ticks = spark.createDataFrame(rows, "batch_id int, completed bigint, ratio double").repartition(5)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {(x["batch_id"], x["completed"]): x["level"] for x in supervise.levels(ticks).collect()}
        assert supervise.levels(ticks.limit(0)).count() == 0
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == {(b, n): x for b in {b for b, *_ in rows} for n, x in enumerate(by_hand([x for a, _, x in rows if a == b]))}


def test_every_retry_counts(spark, duck):
    first = lambda rows: f"select case_no, arg_min(status, event_id) as status from attempts where {rows} group by case_no"
    whole = want(duck, oracle(("attempts",), f"""with f as ({first("status = 'failed'")}), r as ({first("attempt > 1")}) select f.case_no, coalesce(r.status, f.status), r.status is not null from f left join r on r.case_no = f.case_no"""))
    assert got(spark, "retry_merge", "case_no", "status", "replaced") == whole


NOISY = "select case_id, ord, home_world, concat(substr(home_world, 1, l_suppkey % 5 + 2), case when l_partkey % 2 = 0 then 'x' else '' end, substr(home_world, l_suppkey % 5 + 2 + case when l_partkey % 3 = 0 then 2 else 1 end, 40)) as read from reads"


def common_length(a, b):
    """The length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_every_read_is_snapped(spark, duck):
    names = ", ".join(f"'{w}'" for w in vocab.WORLDS)
    duck.execute(f"create or replace table noisy as {oracle(('reads',), NOISY)}")
    scored = f"select n.*, c, list_position([{names}], c) as i, (1 - levenshtein(read, c) / greatest(length(read), length(c))::double) * 100 as s from noisy n cross join (select unnest([{names}]) as c)"
    best = want(duck, f"select case_id, ord, read, c from ({scored}) qualify row_number() over (partition by case_id, ord order by s desc, i) = 1")
    assert len(best) == 6000 and got(spark, "vocab_snap", "case_id", "ord", "read", "best") == best
    home = {r[:2]: r[2] for r in duck.execute("select case_id, ord, home_world from noisy").fetchall()}
    rows = [(home[c, o], read, b) for c, o, read, b in best]
    assert got(spark, "corrector_benchmark", "garbled", "fixed", "broken") == [(sum(r != h for h, r, _ in rows), sum(r != h == b for h, r, b in rows), sum(r == h != b for h, r, b in rows))]
    ratio = {r: max(200 * common_length(r, w) / (len(r) + len(w)) for w in vocab.WORLDS) for _, r, _ in rows}
    found = catalogue.queries()["indel_snap"](spark, SF).collect()
    assert sorted((r["case_id"], r["ord"]) for r in found) == sorted(r[:2] for r in best)
    reads = {r[:2]: r[2] for r in best}
    assert all(abs(r["score"] - ratio[reads[r["case_id"], r["ord"]]]) < 1e-3 for r in found)
