"""Language identification learns every language, from whole texts."""

import random

import numpy as np
import pytest

from casegrid.llm import crf, langid

from .helpers import documents, held


def test_more_languages_than_any_cap(spark):
    r = random.Random(4)
    names = [f"l{i:03}" for i in range(120)]
    words = {x: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for x in names}
    rows = [(i, " ".join(r.choices(words[x], k=20)), x) for i, x in enumerate(x for k, x in enumerate(names) for _ in range(10 if k < 110 else 7))]
    docs = documents(spark, rows)
    model = langid.fit(docs)
    assert model.languages == names
    rare = {i: x for i, _, x in rows if x >= "l110"}
    got = {d["doc_id"]: d["lang_pred"] for d in langid.predicted(docs, model, ["doc_id"]).collect()}
    assert np.mean([got[i] == x for i, x in rare.items()]) > 0.9


def test_late_parts_of_long_texts_are_learned(spark):
    ids = [i for i in range(40) if not held(i, 5, 0)]
    docs = documents(spark, [(i, "first words " * 1000 + "later " * 2000, "en") for i in ids] + [(i + 1000, "autre mot " * 50, "fr") for i in range(20)])
    model = langid.fit(docs)
    assert "later" in model.lexicon and "first" in model.lexicon


def test_a_rare_language_has_its_turn():
    spans = [(20, 0)] * 5000 + [(20, 1)]
    taken = langid.turns(spans, np.random.default_rng(1), 1000)
    assert 5000 in taken and len(taken) == 50
    assert sorted(langid.turns(spans, np.random.default_rng(1), 10**9)) == list(range(5001))


class Rows:
    """A table whose words are their own numbers."""

    def __init__(self, rows):
        self.rows = rows


@pytest.mark.parametrize("labels", [2, 4, 13])
def test_blocks_of_a_long_text_are_one_chain(labels):
    """Strong transitions and weak words: labels far back count. Against one unblocked pass over each text."""
    r = np.random.default_rng(labels)
    model = langid.Tagger()
    model.languages = [str(k) for k in range(labels)]
    model.trans, model.start = r.normal(size=(labels, labels)) + 6 * np.eye(labels), r.normal(size=labels)
    lengths = np.array([63, 64, 65, 128, 129, 1, 1000, 0, 640, 7])
    E = (r.normal(size=(int(lengths.sum()), labels)) * 0.7).astype(np.float32)
    got = model.shares(Rows(E), np.arange(len(E)), lengths)
    at = 0
    for n, found in zip(lengths, got, strict=True):
        own = E[at : at + n].astype(np.float64)[:, None]
        want = crf.posteriors(own, np.array([n]), model.trans, model.start)[:, 0].sum(0) if n else np.zeros(labels)
        assert np.abs(found - want).max() <= 1e-5 * max(n, 1)
        at += n


def test_all_grams_of_a_long_word_count():
    word = "международной"
    assert len(langid.Tagger().features(word)) == 1 + 3 + 3 + 26 + 27
    rows = crf.Ragged([[1, 2], [3], [2, 2, 4]])
    W = np.arange(10, dtype=np.float32).reshape(5, 2)
    assert rows.sums(W).tolist() == [[6, 8], [6, 7], [16, 19]] and rows.sums(W, np.array([2, 0])).tolist() == [[16, 19], [6, 8]]


def test_the_sample_is_the_first_of_each_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 30)
    rows = [(i, x) for i, x in enumerate(["en"] * 900 + ["fr"] * 31 + ["de"] * 5)] + [(7, "en")]
    table = spark.createDataFrame(rows, "doc_id long, lang string")
    hashed = {r["doc_id"]: r["h"] for r in table.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    want = [(i, x) for lang in ("en", "fr", "de") for _, i, x in sorted((hashed[i], i, x) for i, x in rows if x == lang)[:30]]
    assert sorted(map(tuple, langid.first_of_each(table).collect())) == sorted(want)


def test_empty_tables(spark):
    none = documents(spark, [])
    model = langid.fit(none)
    assert model.languages == [] and langid.predicted(none, model, ["doc_id"]).count() == 0
    some = documents(spark, [(1, "words of a kind"), (2, None), (3, "12 !")])
    assert {(d["lang_pred"], d["score"]) for d in langid.predicted(some, model, ["doc_id"]).collect()} == {("und", 0.0)}
    taught = langid.Tagger()
    taught.fit([("words of a kind " * 30, "en"), ("autre mot ici " * 30, "fr")])
    assert langid.predicted(none, taught, ["doc_id"]).count() == 0
    got = {d["doc_id"]: d["lang_pred"] for d in langid.predicted(documents(spark, [(1, "x" * 300_000), (2, None), (3, "kind of words"), (3, "kind of words")]), taught, ["doc_id"]).collect()}
    assert got[2] == "und" and got[3] == "en" and got[1] in ("en", "fr")
