import random
from collections import Counter

import numpy as np

from casegrid.llm import decontamination as d

from .helpers import documents, odd_table, prose


def brute(docs, items):
    """Every window of every document against every item."""
    out = set()
    for i, text in docs:
        words = d.words_of(text or "")
        for k, item in items:
            own = Counter(d.shingles(d.words_of(item or "")))
            size = len(d.words_of(item or ""))
            if not size or not words:
                continue
            n = min(size, len(words))
            best = None
            for a in range(len(words) - n + 1):
                other = Counter(d.shingles(words[a : a + n]))
                both = sum((own & other).values())
                s = both / (own.total() + other.total() - both)
                if s >= d.SIMILAR and (best is None or s > best[0]):
                    best = (s, a)
            if best:
                out.add((i, k, round(best[0], 9), best[1]))
    return out


def planted(seed=4):
    r = random.Random(seed)
    items = [(k, prose(r, r.choice([3, 4, 5, 6, 12, 30, 30, 55]))) for k in range(30)] + [(90, None), (91, ""), (92, "..."), (93, "one"), (None, "null id words here now")]
    docs = []
    for i in range(160):
        words = prose(r, r.randint(0, 120)).split()
        if r.random() < 0.7:
            item = r.choice(items[:30])[1].split()
            for _ in range(r.choice([0, 0, 1, 2])):
                j = r.randrange(len(item))
                if r.random() < 0.5:
                    item[j] = "changed"
                else:
                    item.insert(j, "more")
            at = r.randrange(len(words) + 1)
            words[at:at] = item
        docs.append((i, " ".join(words)))
    return [*docs, (500, None), (501, ""), (502, "one"), (503, "It was ONE, of them")], items


def test_against_brute_force(spark):
    docs, items = planted()
    want = brute(docs, [x for x in items if x[0] is not None])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.leaks(documents(spark, docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"], round(r["similarity"], 9), r["first_word"]) for r in got} == want
    assert len(got) == len(want) > 50
    left = d.without(documents(spark, docs), benchmark)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in docs} - {x[0] for x in want}


def test_more_passes_give_the_same(spark, monkeypatch):
    docs, items = planted(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted(map(tuple, d.leaks(documents(spark, docs), benchmark).collect()))
    once = rows()
    monkeypatch.setattr(d, "PASS_CHARS", 900)
    assert rows() == once


def test_every_fingerprint_within_the_radius_is_listed():
    import numpy as np

    r = np.random.default_rng(2)
    prints = r.integers(0, 2**63, 60, dtype=np.uint64)
    sized = d.Sized(list(range(60)), prints)
    windows = prints[r.integers(0, 60, 400)].copy()
    for k in range(400):
        for b in r.choice(64, int(r.integers(0, 30)), replace=False):
            windows[k] ^= np.uint64(1) << np.uint64(b)
    want = {(int(w), int(i)) for w, i in zip(*np.nonzero(np.bitwise_count(windows[:, None] ^ prints) <= d.RADIUS), strict=True)}
    assert set(zip(*(x.tolist() for x in sized.candidates(windows)), strict=True)) == want


def test_odd_inputs(spark):
    items = spark.createDataFrame([(1, "one two three four five six"), (1, "1" * 50_000), (2, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.leaks(odd_table(spark), items).collect()}
    assert got == {(None, 1), (6, 1), (10, 1)}
    assert d.without(odd_table(spark), items).columns == odd_table(spark).columns
    assert d.leaks(documents(spark, []), items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.leaks(odd_table(spark), none).count() == 0 and d.without(odd_table(spark), none).count() == 13


def test_the_tables_prune_and_lose_little():
    """Unrelated fingerprints: under a tenth of all pairs is looked at. Copies at similarities from 0.8 up: nearly all found."""
    import numpy as np

    r = np.random.default_rng(6)
    prints = r.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 8, dtype=np.uint64)
    windows = r.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2)
    (_, _, tables), = d.Sized(list(range(8)), prints).eights
    listed = tables[0][windows.view(np.uint16).reshape(-1, 4)[:, 0]]
    for b in range(1, 4):
        listed = listed | tables[b][windows.view(np.uint16).reshape(-1, 4)[:, b]]
    assert np.bitwise_count(listed).sum() < 0.1 * 8 * len(windows)

    rand = random.Random(7)
    items = [(k, prose(rand, rand.randint(40, 59))) for k in range(30)]
    docs = []
    for i in range(260):
        words = rand.choice(items)[1].split()
        for _ in range(rand.choice([1, 1, 2])):
            words[rand.randrange(len(words))] = "changed"
        docs.append((i, prose(rand, 30) + " " + " ".join(words) + " " + prose(rand, 30)))
    index = d.Index(items)
    want = {(i, k): s for i, k, s, _ in brute(docs, items)}
    got = {(i, index.ids[n]): round(s, 9) for (i, _), m in zip(docs, index.matches([t for _, t in docs]), strict=True) for n, (s, _) in m.items()}
    assert len(want) > 60 and not set(got) - set(want) and all(want[x] == s for x, s in got.items())
    assert len(got) >= 0.97 * len(want)


def test_growing_windows_equal_those_from_counts(monkeypatch):
    """Fingerprints from planes of bits are those of the windows' counts, to the last place and at odd and even lengths;
    items of many lengths take this way, and find what counts find."""
    r = np.random.default_rng(8)
    for n, most, longest in ((200, 64, 63), (200, 300, 127), (20, 7, 55), (5, 9, 11), (0, 4, 9), (400, 130, 127)):
        hashes = r.integers(0, 2**64, n, dtype=np.uint64)
        hashes[n // 2 :] = hashes[n // 2 :] & hashes[-1:] if n else hashes
        seen = 0
        for m, prints in d.growing(hashes, most, longest):
            assert len(prints) == min(most, n - m + 1)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(int)
            want = [np.packbits(bits[p : p + m].sum(0) > m // 2, bitorder="little").view(np.uint64)[0] for p in range(len(prints))]
            assert prints.tolist() == want
            seen = m
        assert seen == min(longest, n)
    rng = random.Random(12)
    items = [(k, prose(rng, 5 + k)) for k in range(40)]
    texts = [" ".join([prose(rng, rng.randint(0, 60)), items[rng.randrange(40)][1], prose(rng, 9)]) for _ in range(80)]
    calls = []
    grown = d.growing
    monkeypatch.setattr(d, "growing", lambda *a: (calls.append(a), grown(*a))[1])
    monkeypatch.setattr(d, "SLICED", 700)
    fast = d.Index(items).matches(texts)
    assert len(calls) > 3 and sum(map(len, fast)) >= 80
    monkeypatch.setattr(d, "DENSE", 0)
    assert d.Index(items).matches(texts) == fast


def test_words_of_ascii_are_those_of_the_pattern():
    texts = ["".join(map(chr, range(128))), "a_b\x1cC9--d\n", "", "é_b\x1cC9 ", " \x00x\x7fy"]
    assert [d.words_of(t) for t in texts] == [d.WORD.findall(t.lower()) for t in texts]
