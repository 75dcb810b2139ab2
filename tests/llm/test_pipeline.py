"""The pipeline's stages, each held against its operator's own rules on what the stage before it kept."""

import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from casegrid.llm import common, decontamination, pii

from .helpers import DOCUMENTS, LABELS, labelled_corpus, odd_table, prose
from .test_simhash import brute_components, brute_fingerprint
from .test_spans import brute_pii


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with junk, copies, a benchmark passage and personal data."""
    base = tmp_path_factory.mktemp("sf")
    docs, labels = labelled_corpus(seed=11, n=400)
    r = random.Random(12)
    items = [(k, prose(r, 40)) for k in range(5)]
    extra = []
    for i in range(30):
        extra.append((1000 + i, docs[i][1], "en"))
    for i in range(10):
        extra.append((2000 + i, prose(r, 60) + " " + items[i % 5][1] + " " + prose(r, 60), "en"))
    for i in range(10):
        extra.append((3000 + i, prose(r, 80) + f" write to u{i}@mail.example.com or +1 (415) 555-01{i:02d} now " + prose(r, 30), "en"))
    rows = [(i, t, x, "s", len(t)) for i, t, x in [*docs, *extra]]
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return str(base), labels, items


def test_stages(spark, folder, tmp_path):
    base, labels, items = folder
    common.prepare(spark)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    kept = [{r["doc_id"]: r["text"] for r in docs.collect()}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, base).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == DOCUMENTS.names
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    first, good, single, clean, masked = kept
    bad = {i for i, q, _ in labels if q == 0}
    bad |= {1000 + i for i in bad if i < 30}  # copies of junk
    assert len(bad & set(good)) <= 0.05 * len(bad) and len(set(first) - bad - set(good)) <= 0.03 * len(first)
    want = brute_components({i: brute_fingerprint(t) for i, t in good.items()})
    assert set(single) == set(want.values()) and set(good) - set(single)
    index = decontamination.Index(items)
    assert set(clean) == {i for i, t in single.items() if not index.matches([t])[0]}
    assert not {2000 + i for i in range(10)} & set(clean)
    assert set(masked) == set(clean)
    for i, t in masked.items():
        assert not brute_pii(t)
        assert (t == clean[i]) == (not pii.all_spans([clean[i]], pii.Field())[0][1])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {}
    for r in docs.collect():
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in masked.items()}
    whole = sorted(json.dumps(r.asDict(), sort_keys=True) for r in corpus_pipeline.run(spark, base).select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert whole == sorted(json.dumps(r.asDict(), sort_keys=True) for r in docs.select("doc_id", "piece", "start", "length", "ids_crc32").collect())


def odd_folder(spark, base, docs, labels, items):
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return str(base)


def test_odd_documents(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns, with labels of one class and null items."""
    base = odd_folder(spark, tmp_path, odd_table(spark), [(4, 1, 0), (None, 0, 0), (6, None, None)], [(1, "long words here " * 5), (2, None), (None, "x")])
    got = corpus_pipeline.run(spark, base).collect()
    # 2 and 3 have no words, like the null text of 1; 5 repeats 4; 9 leaks item 1; without an id, all stay
    assert {r["doc_id"] for r in got} == {None, 1, 4, 6, 7, 8, 10, -3}
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096


def test_empty_tables(spark, tmp_path):
    docs, labels = labelled_corpus(seed=3, n=60)
    rows = [(i, t, x, "s", len(t)) for i, t, x in docs]
    table = spark.createDataFrame(rows, DOCUMENTS)
    none = corpus_pipeline.run(spark, odd_folder(spark, tmp_path / "a", table.limit(0), [], []))
    assert none.count() == 0 and {"doc_id", "piece", "sequence_id"} <= set(none.columns)
    assert corpus_pipeline.run(spark, odd_folder(spark, tmp_path / "b", table, [], [])).select("doc_id").distinct().count() > 50
