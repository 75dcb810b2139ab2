import numpy as np

from casegrid.llm import embeddings as e

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """{vec_id: (links, least reachable)} for rows with their own ids"""
    good = [(i, np.array(v, np.float32).astype(float), x) for i, v, x in rows if i is not None and x is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    least = {i: i for i, _, _ in rows}
    links = dict.fromkeys(least, 0)
    pairs = [(i, j) for i, a, x in good for j, b, y in good if i != j and x == y and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93]
    for i, _ in pairs:
        links[i] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if least[i] < least[j]:
                least[j], changed = least[i], True
    return {i: (links[i], least[i]) for i in least}


def rows_of(seed, n=400, dim=6):
    r = np.random.default_rng(seed)
    X = r.normal(size=(n, dim))
    for k in range(0, n, 3):
        X[k] = X[int(r.integers(n))] + r.normal(size=dim) * 0.2
    X[5] = X[6] = X[7] = X[8]
    X[9] = X[8] * 3
    return [(i, [float(np.float32(c)) for c in X[i]], int(r.integers(3))) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    rows = [*rows_of(1), (1000, None, 1), (1001, [0.0] * 6, 1), (1002, [], 1), (1003, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1004, [float("nan")] * 6, 1), (1005, [float("inf")] + [0.0] * 5, 1), (1006, rows_of(1)[8][1], None), (1007, [1.0, 2.0], 1), (1008, [2.0, 4.0], 1)]
    want = brute(rows)
    for base, probes, cell in ((1024, 8192, 4096), (16, 40, 4096), (1024, 8192, 30), (8, 20, 12)):  # many blocks and chunks, many cells, both
        monkeypatch.setattr(e, "BASE", base)
        monkeypatch.setattr(e, "PROBES", probes)
        monkeypatch.setattr(e, "CELL", cell)
        got = e.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_visits_lose_no_link():
    r = np.random.default_rng(4)
    X = e.unit(r.normal(size=(600, 16)))
    X = np.concatenate([X, e.unit(X + r.normal(size=X.shape) * 0.09)])
    C = e.centroids(X, 40)
    own, rows, at = e.cells(X, C)
    there = {(i, int(c)) for i, c in enumerate(own)} | set(zip(rows.tolist(), at.tolist(), strict=True))
    pairs = np.argwhere(np.triu(X @ X.T >= e.LEAST, 1))
    assert len(pairs) > 300
    for i, j in pairs.tolist():
        assert (i, int(own[j])) in there or (j, int(own[i])) in there


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert e.near_duplicates(empty).count() == 0
    rows = [(None, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (2, [1.0, 0.1], 1, "x"), (3, [1.0, 0.0], 2, "x")]
    got = e.near_duplicates(spark.createDataFrame(rows, SCHEMA + ", n_links string")).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got) == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_rows_of_several_labels_may_share_a_name(spark):
    """Equal ids, and equal vectors, under different labels: nothing links across labels."""
    a, b = [1.0, 0.0], [0.0, 1.0]
    rows = [(5, a, 0), (6, a, 0), (5, b, 1), (7, b, 1), (7, a, 2), (8, [1.0, 0.01], 2), (9, b, 3)]
    got = e.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(5, 1, 5), (5, 1, 5), (6, 1, 5), (7, 1, 5), (7, 1, 7), (8, 1, 7), (9, 0, 9)]


def test_cells_grow_with_the_rows(spark, monkeypatch):
    """Clusters of vectors: four times the rows have four times the cells, and no more visits a vector."""
    monkeypatch.setattr(e, "CELL", 100)
    r = np.random.default_rng(5)
    centres = e.unit(r.normal(size=(40, 16)))
    visits = []
    for k in (1000, 4000):
        X = e.unit(centres[r.integers(0, 40, k)] + r.normal(size=(k, 16)) * 0.02)
        C = e.centroids(X, k // 100)
        own, rows, _ = e.cells(X, C)
        assert len(np.unique(own)) > k // 200
        visits.append(len(rows) / k)
    assert visits[1] < 2 * visits[0] + 1
