import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casegrid.llm import packing

from .helpers import documents, odd_table, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@given(st.lists(st.text(alphabet="aAbéÉ.,'s<|>ΣİǺ‍ͅ \n\t½漢x1", max_size=20), max_size=6))
@settings(max_examples=300, deadline=None)
def test_chunks_give_the_tokenizers_ids(texts):
    whole = Tokenizer.from_file(PATH) if not hasattr(packing, "_whole") else packing._whole
    packing._whole = whole
    own = packing.ChunkIds.of(PATH).encode(texts)
    assert own == [np.array(ids_of(whole, t), "<u4").tobytes() for t in texts]


def test_special_strings_and_long_chunks(tokenizer):
    texts = ["<|endoftext|> a", "<|STARTOFTEXT|>.", "x" * 9000 + ".", "it's DON'T. we'll,", "ΣΊΣΥΦΟΣ. İ, İstanbul.", "a\x1cb\x85c　d\r\n", "\U0001f600."]
    assert packing.ChunkIds(PATH).encode(texts) == [np.array(ids_of(tokenizer, t), "<u4").tobytes() for t in texts]


def test_caches_keep_what_is_in_use(tokenizer, monkeypatch):
    """Words of every batch are encoded once, however many others come and go; what is kept stays bounded."""
    monkeypatch.setattr(packing, "MOST_CHUNKS", 60)
    monkeypatch.setattr(packing, "MOST_WORDS", 60)
    own, asked = packing.ChunkIds(PATH), Counter()
    for name in ("_line", "_each"):
        encode = getattr(own, name)
        monkeypatch.setattr(own, name, lambda words, encode=encode: (asked.update(words), encode(words))[1])
    r = random.Random(7)
    for k in range(40):
        texts = [f"always there, {prose(r, 12)} it's", "z" * 30_000 * (k == 20) + " there"]
        assert own.encode(texts) == [np.array(ids_of(tokenizer, t), "<u4").tobytes() for t in texts]
        assert max(map(len, (own.chunks, own.old_chunks, own.words, own.old_words))) < 60
    assert asked["always"] == asked["there"] == 1
    monkeypatch.setattr(packing, "MOST_CHARS", 1000)
    for k in range(3):
        own.encode(["y" * 2000 + str(k)])
    assert sum(map(len, [*own.chunks, *own.old_chunks])) < 5000


def slots(places):
    """Each length's places in rank order, from a plan."""
    out = defaultdict(list)
    for length, first, n, sequence, offset, times in places.tolist():
        assert len(out[length]) == first
        out[length] += [(sequence + k // n, offset + k % n * length) for k in range(n * times)]
    return out


@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
@settings(max_examples=200, deadline=None)
def test_plans_hold_every_piece_without_gaps(lengths, capacity):
    histogram = Counter(lengths)
    placed = slots(packing.plan(histogram, capacity))
    assert {x: len(v) for x, v in placed.items()} == dict(histogram)
    bins = defaultdict(list)
    for x, v in placed.items():
        for sequence, offset in v:
            bins[sequence].append((offset, x))
    for own in bins.values():
        at = 0
        for offset, x in sorted(own):
            assert offset == at
            at += x
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))


def test_two_pieces_replace_the_smallest():
    # greedy: 60 + 30, gap 10; 30 goes and 25 + 15 fill the 40 that are then free
    places = packing.plan({60: 1, 30: 1, 25: 1, 15: 1}, 100)
    first = {x for x, _, _, sequence, _, _ in places.tolist() if sequence == 0}
    assert first == {60, 25, 15}
    assert packing.best_two(np.bincount([7, 7, 5], minlength=20), 14) == (7, 7)
    assert packing.best_two(np.bincount([7, 5], minlength=20), 14) in {(7, 5), (5, 7)}
    assert packing.best_two(np.bincount([7], minlength=20), 14) == (0, 0)


def test_packing_is_near_the_bound():
    r = random.Random(1)
    histogram = Counter(min(4096, max(1, int(r.lognormvariate(6.3, 1)))) for _ in range(20_000))
    total = sum(x * n for x, n in histogram.items())
    assert max(s for *_, s, _, _ in packing.plan(histogram)[:, :4].tolist() for s in [0]) == 0
    sequences = max(int(row[3] + row[5]) for row in packing.plan(histogram))
    assert sequences <= -(-total // 4096) + 2


def test_query_round_trip(spark, tokenizer):
    r = random.Random(3)
    rows = [(i, prose(r, r.choice([0, 1, 5, 50, 400, 900]))) for i in range(80)] + [(100, None), (101, prose(r, 9000)), (102, "Same."), (103, "Same."), (104, "word " * 4095), (105, "word " * 4096)]
    got = packing.packed(documents(spark, rows), PATH).collect()
    by = defaultdict(list)
    for x in got:
        by[x["doc_id"]].append(x)
    for i, text in rows:
        ids = ids_of(tokenizer, text)
        own = sorted(by[i], key=lambda x: x["piece"])
        assert [x["piece"] for x in own] == list(range(len(own))) and len(own) == -(-len(ids) // 4096)
        at = 0
        for x in own:
            assert x["start"] == at and x["ids_crc32"] == zlib.crc32(np.array(ids[at : at + x["length"]], "<u4").tobytes())
            at += x["length"]
        assert at == len(ids)
    bins = defaultdict(list)
    for x in got:
        bins[x["sequence_id"]].append((x["offset"], x["length"]))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 4096


def test_odd_inputs(spark):
    got = packing.packed(odd_table(spark), PATH)
    assert got.select("doc_id", "piece").where("piece = 0").count() == 13
    assert got.where("doc_id = 1").first()["length"] == 1
    assert packing.packed(documents(spark, []), PATH).count() == 0


def test_the_join_by_partition_and_length_is_no_broadcast(spark):
    rows = packing.packed(documents(spark, [(1, "a b c"), (2, "d")]), PATH)
    rows.collect()  # adaptive execution turns joins into broadcasts as it goes
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
