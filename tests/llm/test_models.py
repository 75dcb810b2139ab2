"""The classifiers, held to their results on documents kept from learning."""

import numpy as np
import pytest

from casegrid.llm import common, crf, langid, quality, toxicity

from .helpers import LABELS, documents, held, labelled_corpus, odd_table, prose


@pytest.fixture(scope="module")
def corpus(spark):
    common.prepare(spark)
    docs, labels = labelled_corpus()
    return documents(spark, docs).cache(), spark.createDataFrame(labels, LABELS).cache(), docs, {i: (q, t) for i, q, t in labels}


def test_quality_held_out(spark, corpus):
    docs, labels, _, truth = corpus
    got = {r["doc_id"]: r for r in quality.scored(docs, quality.fit(docs, labels), ["doc_id"]).collect()}
    rest = [i for i in truth if held(i, 3, 1)]
    assert len(rest) > 100
    assert np.mean([got[i]["predicted"] == truth[i][0] for i in rest]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_quality_does_not_read_held_out_labels(spark, corpus):
    docs, labels, _, truth = corpus
    turned = spark.createDataFrame([(i, 1 - q if held(i, 3, 1) else q, t) for i, (q, t) in truth.items()], LABELS)
    a, b = (quality.fit(docs, x) for x in (labels, turned))
    assert np.allclose(a.means, b.means) and np.allclose(a.whiten, b.whiten)


def test_discriminant_is_the_difference_of_gaussian_densities():
    r = np.random.default_rng(1)
    X = np.concatenate([r.normal(0, 1, (400, 3)), r.normal(2, 2, (300, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0], [0, 0, 1]])])
    y = np.array([0] * 400 + [1] * 300)
    m = quality.Discriminant(X, y)
    Z = (X - m.centre) / m.spread
    logs = []
    for c in (0, 1):
        factor = np.linalg.inv(m.whiten[c])
        s = factor @ factor.T
        d = Z - m.means[c]
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    assert np.allclose(m.difference(X), np.clip(logs[1] - logs[0], -60, 60))
    assert ((m.score(X) >= 0.5) == y).mean() > 0.85


def test_quality_keeps_its_own_columns(spark, corpus):
    docs, labels, _, truth = corpus
    left = quality.kept(docs, labels)
    assert left.columns == docs.columns
    ids = {r["doc_id"] for r in left.collect()}
    assert np.mean([truth[i][0] for i in ids]) > 0.97


def test_quality_odd_inputs(spark, corpus):
    docs, labels, _, _ = corpus
    model = quality.fit(docs, labels)
    got = quality.scored(odd_table(spark), model, ["doc_id", "score", "n_chars"])
    assert got.columns == ["doc_id", "n_chars", "score", "predicted"]
    assert got.count() == 13 and got.where("score between 0 and 1").count() == 13
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality.scored(odd_table(spark), quality.fit(docs, none), ["doc_id"]).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0), (5, 0, 0), (5, 1, 0)], LABELS)
    assert {r["predicted"] for r in quality.scored(odd_table(spark), quality.fit(docs, one), ["doc_id"]).collect()} == {1}
    assert quality.scored(documents(spark, []), model, ["doc_id"]).count() == 0


def test_toxicity_held_out(spark, corpus):
    docs, labels, _, truth = corpus
    got = {r["doc_id"]: r for r in toxicity.scored(docs, toxicity.fit(docs, labels), ["doc_id"]).collect()}
    rest = [i for i in truth if held(i, 5, 0)]
    assert len(rest) > 60
    assert np.mean([got[i]["predicted"] == truth[i][1] for i in rest]) > 0.9
    odd = toxicity.scored(odd_table(spark), toxicity.fit(docs, labels), ["doc_id", "predicted"])
    assert odd.columns == ["doc_id", "score", "predicted"] and odd.where("score between 0 and 1").count() == 13
    assert toxicity.scored(documents(spark, []), toxicity.fit(docs, spark.createDataFrame([], LABELS)), ["doc_id"]).count() == 0
    assert {r["predicted"] for r in toxicity.scored(odd_table(spark), toxicity.fit(docs, spark.createDataFrame([], LABELS)), ["doc_id"]).collect()} == {0}


def test_toxicity_thresholds_come_from_every_label(spark, monkeypatch):
    """Labelled documents beyond the sample of the weights move the thresholds and the counts of words: here, all of them."""
    import random

    r = random.Random(6)
    ids = [i for i in range(1400) if not held(i, 5, 0)][:1000]
    rows, truth = [], []
    for i in ids:
        toxic = r.random() < 0.5
        words = prose(r, 12).split()
        rows.append((i, " ".join([*words, "idiot" if toxic else "kind"]), r.choice(["en", "fr"])))
        truth.append((i, None, int(toxic)))
    docs = documents(spark, rows)
    monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", 60)
    net, learned = toxicity.trained(docs, spark.createDataFrame(truth, LABELS))
    assert 60 < len(learned) <= 120 and net.languages == ["en", "fr"]
    words = [w for _, t, x in rows if x == "en" for w in toxicity.WORD.findall(t)]
    assert np.isclose(net.short["idiot"][0], np.log((words.count("idiot") + 0.5) / (len(words) + 1)) - np.log(1e-6), atol=1e-4)
    known = spark.createDataFrame([(i, i / 100, 0) for i in ids], "doc_id long, logit double, language int")
    labels = lambda cut: spark.createDataFrame([(i, None, int(i >= cut)) for i in ids], LABELS)
    for cut in (ids[333], ids[777]):  # the one cut without a mistake, which is known only to who has all labels
        before = max(i for i in ids if i < cut)
        got = toxicity.calibrated(net, known, labels(cut), [], "doc_id").threshold[0]
        assert before / 100 < got <= cut / 100
    held_out = [i for i in range(1400) if held(i, 5, 0)]
    more = known.union(spark.createDataFrame([(i, 50.0, 0) for i in held_out], known.schema))
    wrong = labels(ids[777]).union(spark.createDataFrame([(i, None, 0) for i in held_out], LABELS))
    assert toxicity.calibrated(net, more, wrong, []).threshold[0] == got  # labels of the held-out fold change nothing
    fitted = toxicity.fit(docs, spark.createDataFrame(truth, LABELS))
    one = {x["doc_id"]: x for x in toxicity.scored(docs, fitted, ["doc_id"]).collect()}
    two = {x["doc_id"]: x for x in toxicity.judged(docs, spark.createDataFrame(truth, LABELS)).collect()}
    assert one.keys() == two.keys() and all(abs(one[i]["score"] - two[i]["score"]) < 1e-6 and one[i]["predicted"] == two[i]["predicted"] for i in ids)


def test_network_gradient_and_projection():
    """Training lowers the loss, and scores from the word table equal those from the filters themselves."""
    r = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)]
    docs = [[words[i] for i in r.integers(0, 40, int(r.integers(1, 60)))] for _ in range(120)]
    y = np.array([int("w3" in d) for d in docs])
    own = np.array([[0] * (1 + len(toxicity.PREFIXES)), *map(toxicity.parts, words)])
    ids = [np.array([1 + words.index(w) for w in d]) for d in docs]
    net = toxicity.Network()
    net.train(ids, own, y)
    from casegrid.llm.words import WordTable

    table = WordTable(net.projected, net.width, 10)
    lengths = np.array([len(d) for d in docs])
    flat = table.find([w for d in docs for w in d])
    a, _ = net.logits(table, flat, lengths, block=2048)
    b, _ = net.logits(table, flat, lengths, block=1)
    rows, first = toxicity.placed(np.concatenate(ids), lengths)
    A = net.activations(net.embed[own[rows]].sum(1)).reshape(-1, toxicity.WINDOW, toxicity.POOLED)
    direct = net.pooled(np.maximum(A.max(1), 0), first) @ net.out + net.base
    assert np.allclose(a, direct, atol=1e-3) and np.allclose(a, b, atol=1e-4)
    assert ((a > 0) == y).mean() > 0.95


def test_language_held_out_and_switches(spark, corpus):
    docs, _, rows, _ = corpus
    model = langid.fit(docs)
    got = {r["doc_id"]: r for r in langid.predicted(docs, model, ["doc_id"]).collect()}
    rest = [(i, x) for i, _, x in rows if held(i, 5, 0)]
    assert np.mean([got[i]["lang_pred"] == x for i, x in rest]) > 0.95
    import random

    r = random.Random(8)
    mixed = [(1, prose(r, 90, "en") + " " + prose(r, 30, "de")), (2, prose(r, 30, "en") + " " + prose(r, 90, "de"))]
    both = {r["doc_id"]: r for r in langid.predicted(documents(spark, mixed), model, ["doc_id"]).collect()}
    assert both[1]["lang_pred"] == "en" and both[2]["lang_pred"] == "de"
    assert all(0.6 < x["score"] < 0.9 for x in both.values())
    odd = {(r["doc_id"], r["score"] == 0): r["lang_pred"] for r in langid.predicted(odd_table(spark), model, ["doc_id", "lang_pred"]).collect()}
    assert all(odd[i, True] == "und" for i in (1, 2, 3, 7, 10))
    empty = langid.fit(documents(spark, []))
    assert {r["lang_pred"] for r in langid.predicted(docs, empty, ["doc_id"]).collect()} == {"und"}


def test_forward_backward_and_viterbi_against_enumeration():
    import itertools

    r = np.random.default_rng(4)
    K = 3
    for T in (1, 2, 4):
        E, A, s = r.normal(size=(5, 1, K)), r.normal(size=(K, K)), r.normal(size=K)
        paths = list(itertools.product(range(K), repeat=T))
        score = np.array([s[p[0]] + sum(E[t, 0, p[t]] for t in range(T)) + sum(A[p[t - 1], p[t]] for t in range(1, T)) for p in paths])
        w = np.exp(score - score.max())
        w /= w.sum()
        gamma, pairs = crf.posteriors(E, np.array([T]), A, s, pairs=True)
        want = np.array([[sum(w[i] for i, p in enumerate(paths) if p[t] == k) for k in range(K)] for t in range(T)])
        assert np.allclose(gamma[:T, 0], want) and np.allclose(gamma[T:], 0)
        assert np.isclose(pairs.sum(), T - 1)
        assert tuple(crf.viterbi(E, np.array([T]), A, s)[:T, 0]) == paths[int(score.argmax())]
