"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

A window of a document has as many words as the item it is held against (all of a shorter document). Windows and
items get 64-bit SimHashes of their five-word shingles, windows from running counts of the shingles' bits. Item
fingerprints stand in four tables, one for each block of 16 bits: two fingerprints within RADIUS = 15 bits differ by
at most 3 bits in one block at least, and each table lists for every block value the items within 3 bits. So every
pair within the radius is found, and of unrelated pairs about 4 per cent are looked at.

Candidates are verified by the exact weighted Jaccard similarity of the shingles, a shingle's weight being its count.
Where a candidate's similarity is at least NEAR, all windows that overlap it are held against the item, so that a leak
is found if any of its windows is within the radius. The radius is where a similarity of SIMILAR lies two deviations
inside: an angle of 27 degrees, some 10 of 64 bits. A leak whose windows all lie beyond it is missed; the tests
measure how rarely.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHINGLE, SIMILAR, NEAR, RADIUS, BLOCKS = 5, 0.8, 0.5, 15, 4
#: A pass over the documents takes items of about so many characters, and so many items and lengths; a larger benchmark takes
#: more passes, each with items of neighbouring lengths, so that the windows of a length are made in one of them.
PASS_CHARS, PASS_ITEMS, PASS_SIZES = 4_000_000, 2048, 256
#: Words whose hashes a worker keeps, windows that are made at a time.
MOST_WORDS, MOST_WORD_CHARS, ROWS, SLICED = 300_000, 20_000_000, 16_384, 32_768
#: Lengths are dense where more than one in so many up to the longest is an item's.
DENSE = 3
WORD = re.compile(r"\w+")
#: Of ASCII, what isn't of a word.
BLANKS = {i: " " for i in range(128) if not WORD.match(chr(i))}
_r = np.random.default_rng(11)
MIXERS = _r.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BITS = 64 // BLOCKS
#: All differences of a block that some pair within the radius has in its closest block.
DIFFERENCES = np.array(sorted(sum(1 << p for p in own) for k in range(RADIUS // BLOCKS + 1) for own in itertools.combinations(range(BITS), k)), np.uint16)


def words_of(text: str) -> list[str]:
    text = text.lower()
    return text.translate(BLANKS).split() if text.isascii() else WORD.findall(text)


def shingles(words: list[str]) -> list[str]:
    """Five-word shingles in order; a shorter sequence is one shingle."""
    return [" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


class Words:
    """Hashes of words, kept by a worker while they are few."""

    def __init__(self):
        self.start()

    def start(self) -> None:
        self.numbers: dict[str, int] = {}
        self.values = np.zeros(1024, np.uint64)
        self.chars = 0

    def hashes(self, words: list[str]) -> np.ndarray:
        if len(self.numbers) > MOST_WORDS or self.chars > MOST_WORD_CHARS:
            self.start()
        own = np.fromiter(map(self.numbers.get, words, itertools.repeat(-1)), np.int32, len(words))
        if len(missing := np.flatnonzero(own < 0)):
            unknown = [words[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            first = len(self.numbers)
            while first + len(new) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            self.values[first : first + len(new)] = [xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 9) for w in new]
            self.numbers.update(zip(new, range(first, first + len(new)), strict=True))
            self.chars += sum(map(len, new))
            own[missing] = list(map(self.numbers.__getitem__, unknown))
        return self.values[own]


def mixed(coded: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of hashed words."""
    n = max(0, len(coded) - k + 1)
    x = np.zeros(n, np.uint64)
    for j in range(k):
        x += coded[j : j + n] * MIXERS[j]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def running(hashes: np.ndarray, of: int) -> np.ndarray:
    """[hashes + 1, 64]: how many of the hashes before have each bit. Counts wrap around, but the differences of those
    that are up to ``of`` hashes apart don't: the narrowest numbers that allow it are the fastest."""
    kind = np.uint8 if of < 1 << 8 else np.uint16 if of < 1 << 16 else np.int64
    n = -(-len(hashes) // 64)
    counts = np.zeros((n, 64, 64), kind)  # pieces of 64 hashes, summed side by side and then joined
    counts.reshape(-1, 64)[: len(hashes)] = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    for i in range(1, 64):
        counts[:, i] += counts[:, i - 1]
    counts[1:] += np.cumsum(counts[:-1, -1], 0, dtype=kind)[:, None]
    return np.concatenate([np.zeros((1, 64), kind), counts.reshape(-1, 64)[: len(hashes)]])


def growing(hashes: np.ndarray, most: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For m = 1 to longest (below 128): m, and the SimHashes of the windows of m hashes that begin at the first ``most``
    places, to be read before the next. All 64 counts of a window stand side by side, bit k of each in plane k; they are
    held so far below 2 ** top that plane ``top`` has the bits that more than half of the hashes have."""
    top = 5 if longest < 64 else 6
    n = min(most, len(hashes))
    planes = [np.full(n, -1, np.int64).view(np.uint64) for _ in range(top)] + [np.zeros(n, np.uint64)]
    moves, carries = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for m in range(1, longest + 1):
        n = min(most, len(hashes) - m + 1)
        if n <= 0:
            return
        new, move = hashes[m - 1 : m - 1 + n], moves[:n]
        if m % 2:  # one more where the new hash has the bit
            np.copyto(move, new)
            for plane in planes[:-1]:
                own, carry = plane[:n], carries[:n]
                np.bitwise_and(own, move, out=carry)
                np.bitwise_xor(own, move, out=own)
                move, carries, moves = carry, moves, carries
        else:  # half of m has grown by one: one less where the new hash doesn't have the bit
            np.invert(new, out=move)
            for plane in planes[:-1]:
                own = plane[:n]
                np.bitwise_xor(own, move, out=own)
                np.bitwise_and(move, own, out=move)
        last = planes[-1][:n]
        np.bitwise_xor(last, move, out=last)
        yield m, last


def fingerprint(coded: np.ndarray) -> int:
    """The SimHash of a sequence of hashed words (one at least): the bits that more than half of its shingles have."""
    h = mixed(coded, min(SHINGLE, len(coded)))
    return int(np.packbits(running(h, len(h))[-1] > len(h) // 2, bitorder="little").view(np.uint64)[0])


class Sized:
    """The items of one number of words, with their multi-index: for each eight of them the four tables, a table's entry
    for a block value having a bit for each item that it lists."""

    def __init__(self, items: list[int], prints: np.ndarray):
        self.eights = []
        for k in range(0, len(items), 8):
            own = prints[k : k + 8]
            tables = np.zeros((BLOCKS, 1 << BITS), np.uint8)
            for i, blocks in enumerate(own.view(np.uint16).reshape(-1, BLOCKS)):
                for b in range(BLOCKS):
                    tables[b, blocks[b] ^ DIFFERENCES] |= np.uint8(1 << i)
            self.eights.append((np.array(items[k : k + 8]), own, tables))

    def candidates(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) numbers of all pairs within the radius; of those with one item, by window."""
        blocks = windows.view(np.uint16).reshape(-1, BLOCKS).T.astype(np.intp, order="C")
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for items, prints, tables in self.eights:
            listed = tables[0].take(blocks[0], mode="clip")
            for b in range(1, BLOCKS):
                listed |= tables[b].take(blocks[b], mode="clip")
            at = np.flatnonzero(listed != 0)
            pairs = np.flatnonzero(np.unpackbits(listed[at], bitorder="little").view(bool))
            w, i = at[pairs >> 3], pairs & 7
            close = np.bitwise_count(windows[w] ^ prints[i]) <= RADIUS
            found.append((w[close], items[i[close]]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Index:
    """A part of the benchmark: [(item_id, text)]. Items without words are left out."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(i, words_of(t)) for i, t in items]
        split = [(i, w) for i, w in split if w]
        self.ids = [i for i, _ in split]
        self.counts = [Counter(shingles(w)) for _, w in split]
        self.sizes = [len(w) for _, w in split]
        by_size: dict[int, list[int]] = defaultdict(list)
        for n, size in enumerate(self.sizes):
            by_size[size].append(n)
        words = Words()
        self.held = [frozenset(mixed(words.hashes(w), min(SHINGLE, len(w))).tolist()) for _, w in split]
        self.groups = {s: Sized(own, np.array([fingerprint(words.hashes(split[n][1])) for n in own], np.uint64)) for s, own in sorted(by_size.items())}

    def matches(self, texts: list[str]) -> list[dict[int, tuple[float, int]]]:
        """For each text: item number -> (highest similarity of a window, if at least SIMILAR; the first such window's first word)."""
        split = [words_of(t) for t in texts]
        out: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        lengths = np.array([len(w) for w in split], np.int64)
        if not self.groups or not lengths.sum():
            return out
        ends = np.cumsum(lengths)
        coded = common.kept("benchmark words", Words).hashes([w for d in split for w in d])
        hits: dict[tuple[int, int], list[int]] = defaultdict(list)
        for p, item in self._windows(coded, np.repeat(ends, lengths)):
            d = int(np.searchsorted(ends, p, side="right"))
            hits[d, item].append(p - int(ends[d] - lengths[d]))
        for d, item in self._short(coded, lengths, ends):
            hits[d, item].append(0)
        for (d, item), at in sorted(hits.items()):
            if (best := self.best(split[d], item, at))[0] >= SIMILAR:
                out[d][item] = best
        return out

    def _windows(self, coded: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, item) of the windows within the radius of an item of their length, inside one document."""
        for k in range(1, SHINGLE):
            if k in self.groups:
                hashes = mixed(coded, k)
                yield from self._of_size(k, hashes, 0, end, hashes, 1)
        sizes = [s for s in self.groups if s >= SHINGLE]
        if not sizes or len(coded) < SHINGLE:
            return
        hashes = mixed(coded, SHINGLE)
        for least, most in ((0, 1 << 8), (1 << 8, 1 << 16), (1 << 16, max(sizes) + 1)):
            own = {s: s - SHINGLE + 1 for s in sizes if least <= s - SHINGLE + 1 < most}
            if not own:
                continue
            longest = max(own.values())
            if longest < 128 and longest < DENSE * len(own):  # lengths lie close: from one to the next takes less than to begin anew
                of = {m: s for s, m in own.items()}
                for a in range(0, len(hashes), SLICED):
                    for m, prints in growing(hashes[a : a + SLICED + longest - 1], SLICED, longest):
                        if m in of:
                            yield from self._of_size(of[m], prints, a, end, hashes, m)
                continue
            step = max(ROWS, longest)
            sums = bits = None
            for a in range(0, len(hashes), step):
                counts = running(hashes[a : a + step + longest - 1], longest)
                if sums is None:  # room for the numbers between, used again for each length
                    sums, bits = np.empty((min(step, len(counts)), 64), counts.dtype), np.empty((min(step, len(counts)), 64), bool)
                for s, m in own.items():
                    n = min(step, len(counts) - m)
                    if n > 0:
                        np.subtract(counts[m : m + n], counts[:n], out=sums[:n])
                        np.greater(sums[:n], sums.dtype.type(m // 2), out=bits[:n])
                        yield from self._of_size(s, np.packbits(bits[:n].reshape(-1), bitorder="little").view(np.uint64), a, end, hashes, m)

    def _of_size(self, size: int, prints: np.ndarray, at: int, end: np.ndarray, hashes: np.ndarray, m: int) -> Iterator[tuple[int, int]]:
        """Those of windows of m shingles each that have so many of an item's that their similarity may reach NEAR."""
        w, items = self.groups[size].candidates(prints)
        inside = w + at + size <= end[w + at]
        for p, item in zip((w[inside] + at).tolist(), items[inside].tolist(), strict=True):
            both = sum(map(self.held[item].__contains__, hashes[p : p + m].tolist()))
            if both >= NEAR * (2 * m - both):
                yield p, item

    def _short(self, coded: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) within the radius where the document is shorter than the item, yet has shingles enough."""
        docs = np.flatnonzero((lengths >= SHINGLE) & (lengths < max(self.groups)))
        if not len(docs):
            return
        prints = np.array([fingerprint(coded[ends[d] - lengths[d] : ends[d]]) for d in docs.tolist()], np.uint64)
        for size, group in self.groups.items():
            own = np.flatnonzero((lengths[docs] < size) & (lengths[docs] - SHINGLE + 1 >= SIMILAR * (size - SHINGLE + 1)))
            if len(own):
                w, items = group.candidates(prints[own])
                yield from zip(docs[own[w]].tolist(), items.tolist(), strict=True)

    def best(self, words: list[str], item: int, at: list[int]) -> tuple[float, int]:
        """The highest similarity of the windows around the given ones, and the first window that has it; (0, 0) if
        none of the given ones is near the item."""
        own, n = self.counts[item], min(self.sizes[item], len(words))
        if n < SHINGLE:  # one shingle, equal or not
            return next(((1.0, p) for p in at if shingles(words[p : p + n])[0] in own), (0.0, 0))
        m, last, total = n - SHINGLE + 1, len(words) - n, own.total()
        best, done = (0.0, 0), -1
        for p in at:
            if p <= done:
                continue
            parts = Counter(shingles(words[p : p + n]))
            both = sum(min(c, own[x]) for x, c in parts.items())
            if both < NEAR * (total + m - both):
                continue
            first = max(done + 1, p - n)
            done = min(last, p + n)
            line = shingles(words[first : done + n])
            seen = Counter(line[:m])
            both = sum(min(c, own[x]) for x, c in seen.items())
            for q in range(first, done + 1):
                if q > first:
                    gone, new = line[q - first - 1], line[q - first + m - 1]
                    both -= seen[gone] <= own[gone]
                    seen[gone] -= 1
                    seen[new] += 1
                    both += seen[new] <= own[new]
                if (s := both / (total + m - both)) > best[0]:
                    best = s, q
        return best


def indexes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Index]:
    """The benchmark in parts of bounded size, by length and then a hash of the item's id. Items whose id or text is
    null are left out."""
    own = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("item_id is not null and text is not null").distinct()
    size = F.size(F.split(F.trim("text"), r"\W+"))  # about the number of words; which part an item is in changes nothing
    own = own.select("item_id", "text", size.alias("size"))
    held = own.groupBy("size").agg(F.count(F.lit(1)).alias("items"), F.sum(F.length("text")).alias("chars")).orderBy("size").collect()  # one row a length
    parts: list[tuple[list[int], int]] = []  # lengths that share a pass, or one length and its number of passes
    room = 0.0
    for r in held:
        need = max(r["items"] / PASS_ITEMS, (r["chars"] or 0) / PASS_CHARS, 1 / PASS_SIZES)
        if not parts or parts[-1][1] > 1 or need > 1 or room + need > 1:
            parts.append(([], max(1, int(np.ceil(need)))))
            room = 0.0
        parts[-1][0].append(r["size"])
        room += need
    for sizes, times in parts or [([], 1)]:
        here = own.where(F.col("size").between(sizes[0], sizes[-1])) if sizes else own
        for k in range(times):
            rows = here.where(F.pmod(F.xxhash64("item_id"), F.lit(times)) == k).select("item_id", "text").collect()
            yield Index(sorted((r["item_id"], r["text"]) for r in rows))


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType())])


def passes(benchmark: DataFrame) -> Iterator[tuple[Index, bool]]:
    """Each part of the benchmark with whether it is the only one."""
    parts = indexes(benchmark)
    now = next(parts)
    following = next(parts, None)
    yield now, following is None
    while following is not None:
        yield following, False
        following = next(parts, None)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word): each document with each benchmark item that one of its windows
    resembles at SIMILAR or more, with the best such window (the first, at ties).

    Null texts are empty and match nothing; a null doc_id stays null; items that repeat an id are held against
    documents one by one and each gives its rows. Empty tables give no rows; other columns are ignored. Where the
    benchmark takes several passes, each one's rows are written before the next, so that one index is held at a time.
    """
    common.prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    arrow = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())])
    out = None
    for index, alone in passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in common.pieces(batch):
                    rows = [(d, index.ids[n], s, p) for d, m in zip(part.column(0).to_pylist(), index.matches(common.texts(part, "text")), strict=True) for n, (s, p) in sorted(m.items())]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

        found = source.mapInArrow(run, RESULT)
        if not alone:
            found = found.checkpoint()
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def without(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item leaks, with their own columns. Null and empty texts stay; repeated rows
    share a fate; an empty benchmark leaves all. Each part of the benchmark is one narrow pass, written before the next."""
    common.prepare(docs.sparkSession)
    out = docs
    for index, alone in passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared):
            return lambda batch: [[bool(m) for m in shared.value.matches(common.texts(batch, "text"))]]

        out = common.with_arrow(out, [T.StructField("_leaks", T.BooleanType())], make, keeps=True).where("not _leaks").select(*docs.columns)
        if not alone:
            out = out.checkpoint()
            shared.unpersist()
    return out
