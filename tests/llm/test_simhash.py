import random
import re

import numpy as np
import xxhash

from pyspark.sql import functions as F

from casegrid.llm import components, simhash

from .helpers import documents, odd_table, prose


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """{key: fingerprint} -> {key: least key reachable}"""
    keys = sorted(prints)
    least = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and least[a] < least[b]:
                    least[b], changed = least[a], True
    return least


def test_covering_guarantees_a_collision():
    r = random.Random(5)
    for _ in range(2000):
        flips = sum(1 << b for b in r.sample(range(64), r.randint(0, 4)))
        assert any(m & flips == 0 for m in simhash.MASKS.values())
        t = r.choice(list(simhash.MASKS))
        rest = [p for p in range(64) if not simhash.MASKS[t] >> p & 1]
        inner = sum(1 << b for b in r.sample(rest, r.randint(0, 4)))
        assert any((m | simhash.MASKS[t]) & inner == 0 for m in simhash.FINER[t].values())
    assert all(bin(m).count("1") in range(28, 37) for m in simhash.MASKS.values())


def near_rows(seed=2):
    r = random.Random(seed)
    rows = []
    for _ in range(25):
        base = prose(r, r.randint(3, 120)).split()
        for _ in range(r.randint(1, 5)):
            copy = list(base)
            if r.random() < 0.6:
                copy[r.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy)))
    return [*rows, (900, None), (901, ""), (902, " \x1c "), (903, "A b"), (904, "a\x0bB")]


def test_against_brute_force(spark):
    rows = near_rows()
    prints = {i: brute_fingerprint(x) for i, x in rows}
    want = brute_components(prints)
    for large in (simhash.LARGE, 2):  # 2: every larger bucket takes the second covering
        got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(documents(spark, rows), large=large).collect()}
        assert got == {i: (prints[i], want[i]) for i in prints}


def test_forest_counts_the_sign_bit_like_any_other():
    r = np.random.default_rng(3)
    for _ in range(50):
        base = int(r.integers(0, 2**63)) * 2
        values = {base ^ sum(1 << int(b) for b in r.choice(64, int(r.integers(0, 5)), replace=False)) for _ in range(12)} | {base ^ (1 << 63)}
        signed = [v - 2**64 if v >= 2**63 else v for v in values]
        parts = simhash.forest(np.array(signed, np.int64))
        want = brute_components({s: v for s, v in zip(signed, values, strict=True)})
        assert len(parts) == len(values) - len(set(want.values()))
        assert all(((u ^ v) % 2**64).bit_count() <= 4 for u, v in parts)


def test_crowded_buckets_keep_every_link(spark):
    """Fingerprints of a chain and of a crowd: equal in most bits, so that they share buckets."""
    r = random.Random(9)
    values = {0, *(1 << b for b in range(20)), *(sum(1 << b for b in r.sample(range(24), 7)) for _ in range(150))}
    want = brute_components({v: v for v in values})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    from casegrid.llm import common
    from casegrid.llm.components import components

    common.prepare(spark)
    for large in (2048, 16):
        roots = {r["node"]: r["root"] for r in components(simhash.links(fps, large)).collect()}
        assert {v: roots.get(v, v) for v in values} == want


def test_buckets_are_never_parted_by_an_adaptive_join(spark):
    """A join by the same keys is first planned as a sort-merge join and then, at run time, as a broadcast join that reads
    its input as it lies; the buckets still come whole."""
    from pyspark.sql import functions as F

    r = random.Random(4)
    rows = [(t, k, k * 1000 + i) for t in (1, 2) for k in range(60) for i in r.sample(range(16), 5)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        left = spark.createDataFrame(rows, "t int, key long, fp long").repartition(7)
        right = left.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
        many = left.join(right, ["t", "key"]).select("t", "key", "fp")
        edges = simhash._bucket_edges(many)
        assert "REPARTITION_BY_COL" in edges._jdf.queryExecution().executedPlan().toString()
        got = edges.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    buckets = {}
    for t, k, fp in rows:
        buckets.setdefault((t, k), []).append(fp)
    assert got == sum(len(simhash.forest(np.array(v))) for v in buckets.values())


def test_one_document_of_each_group_stays(spark):
    rows = near_rows()
    want = brute_components({i: brute_fingerprint(x) for i, x in rows})
    left = simhash.kept(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in left) == sorted({*want.values()})


def test_odd_inputs(spark):
    got = simhash.near_duplicates(odd_table(spark)).collect()
    assert len(got) == 13
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    assert by[1, 0] == by[2, 0] == by[3, 0] == 1
    assert {v for (i, _), v in by.items() if i in (4, 5)} == {4}
    assert {v for (i, _), v in by.items() if i in (None, 6)} == {6}
    assert simhash.kept(odd_table(spark)).columns == odd_table(spark).columns
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.kept(documents(spark, [])).count() == 0


def test_plan_does_not_grow_with_the_crowded_tables(spark):
    """One plan deals the crowded buckets of all tables again, as the driver holds every branch of a plan at once."""
    from casegrid.llm import common

    common.prepare(spark)
    r = random.Random(3)
    values = {sum(1 << b for b in r.sample(range(64), 3)) for _ in range(300)}
    fps = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    plans = [simhash.links(fps, large)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") for large in (2048, 2)]
    assert plans[0] == plans[1] == 2
    want = brute_components({v: v for v in values})
    from casegrid.llm.components import components

    roots = {x["node"] % 2**64: x["root"] for x in components(simhash.links(fps, 2)).collect()}
    groups = {}
    for v in values:
        groups.setdefault(want[v], set()).add(roots.get(v, v - 2**64 if v >= 2**63 else v))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_join_of_exploded_rows_is_a_broadcast(spark):
    # a table this small would be broadcast by its estimate, which leaves the factor of an explode out
    prints = spark.range(2000).select(F.xxhash64("id").alias("fp"))
    assert "BroadcastHashJoin" not in plan_of(simhash.links(prints))
    assert "BroadcastHashJoin" not in plan_of(components._to_least(prints.select(F.col("fp").alias("u"), F.col("fp").alias("v"))))
    assert "BroadcastHashJoin" not in plan_of(simhash.near_duplicates(documents(spark, near_rows())))
