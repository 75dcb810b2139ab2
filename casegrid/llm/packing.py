"""Best-two-fit packing of documents into sequences of at most CAPACITY tokens.

A plan needs only how many pieces there are of each length (at most CAPACITY numbers), so it is made on the driver
whatever the corpus size, bin pattern by bin pattern: fill greedily with the longest piece that fits; then take out the
smallest and put in the two unpacked pieces that fill the widened gap best, if they fill it more. A pattern is used as
often as its lengths last. Each piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

CAPACITY, END_ID = 4096, 1
MARKS = string.punctuation
MOST_CHUNKS, MOST_WORDS, MOST_TAILS, MOST_CHARS = 800_000, 800_000, 20_000, 24_000_000


class ChunkIds:
    """Token ids of texts, by way of the chunks between blanks and line feeds.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its chunks in order. It also
    lower-cases, and parts marks from the letter before them; so chunks are taken in lower case where that can't
    matter, and share the ids of their words. New words of letters alone are encoded many at a time, as one line: each
    ends where a word-end token does. Up to MOST_CHUNKS chunks, MOST_WORDS words and MOST_TAILS runs of marks are kept;
    chunks and words in two halves, of which the older gives way, and what is used of it moves on; long ones are fewer, as a
    half also has at most MOST_CHARS // 2 characters.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.chars = 0

    @classmethod
    def of(cls, path: str) -> ChunkIds:
        return common.kept(f"tokens of {path}", lambda: cls(path))

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _line(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters; one by one if the tokenizer doesn't see one word in each."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        raw, cuts = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)] if len(cuts) == len(words) else self._each(words)

    @staticmethod
    def _found(new: set[str], now: dict[str, bytes], old: dict[str, bytes]) -> set[str]:
        """Those of new that neither half has; what the older half has of them is in the newer one afterwards."""
        if known := old.keys() & new:
            now.update(zip(known, map(old.__getitem__, known), strict=True))
            return new - known
        return new

    def _learn(self, new: set[str]) -> None:
        plain = [c for c in new if c.isalpha()]
        parted = []
        for c in new.difference(plain):
            word = c.rstrip(MARKS)
            parted.append((c, word, c[len(word) :]) if word[-1:].isalpha() and word[-1] != "İ" and "<|" not in c else (c, c, ""))
        tails = list({t for _, _, t in parted}.difference(self.tails))
        self.tails.update(zip(tails, self._each(tails), strict=True))
        missing = self._found({w for _, w, _ in parted}.union(plain).difference(self.words), self.words, self.old_words)
        letters = [w for w in missing if w.isalpha()]
        other = list(missing.difference(letters))
        for words, encode, step in ((letters, self._line, 2000), (other, self._each, 5000)):
            for k in range(0, len(words), step):
                part = words[k : k + step]
                self.words.update(zip(part, encode(part), strict=True))
        words, ends = self.words, self.tails
        self.chunks.update(zip(plain, map(words.__getitem__, plain), strict=True))
        self.chunks.update([(c, words[w] + ends[t]) for c, w, t in parted])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers, the end id last."""
        many = self.chars > MOST_CHARS // 2
        if many or len(self.chunks) > MOST_CHUNKS // 2:
            self.chunks, self.old_chunks, self.chars = {"": b""}, self.chunks, 0
        if many or len(self.words) > MOST_WORDS // 2:
            self.words, self.old_words = {}, self.words
        if len(self.tails) > MOST_TAILS:
            self.tails = {"": b""}
        split = [(t.lower() if lowers_alike(t) else t).replace("\n", " ").split(" ") for t in texts]
        if new := set().union(*split).difference(self.chunks):
            self.chars += sum(map(len, new))
            if new := self._found(new, self.chunks, self.old_chunks):
                self._learn(new)
        end = np.array([END_ID], "<u4").tobytes()
        get = self.chunks.__getitem__
        return [b"".join(map(get, chunks)) + end for chunks in split]


def lowers_alike(text: str) -> bool:
    """Whether lower-casing the text first leaves its ids as they are: no letter whose small form depends on its place,
    nothing that normalization would join, and no string that could become a special token."""
    return "<|" not in text and (text.isascii() or ("Σ" not in text and "İ" not in text and unicodedata.is_normalized("NFC", text)))


PIECE = [T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("turn", T.LongType())]


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and turn, its number among the pieces of its length
    in its partition. A null or empty text is the end id alone."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType(PIECE)
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("turn", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ChunkIds.of(tokenizer)
        turns: Counter[int] = Counter()
        for batch in batches:
            for part in common.pieces(batch):
                rows = []
                for d, raw in zip(part.column(0).to_pylist(), ids.encode(common.texts(part, "text")), strict=True):
                    for k, a in enumerate(range(0, len(raw), CAPACITY * 4)):
                        own = raw[a : a + CAPACITY * 4]
                        n = len(own) // 4
                        rows.append((d, k, a // 4, n, zlib.crc32(own), turns[n]))
                        turns[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def longest(counts: np.ndarray, most: int) -> int:
    """The greatest length with pieces left that is at most ``most``; 0 if there is none."""
    left = np.flatnonzero(counts[1 : most + 1])
    return int(left[-1]) + 1 if len(left) else 0


def best_two(counts: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths with pieces left that sum to the most within room; (0, 0) if there are none."""
    left = np.flatnonzero(counts[1 : max(room, 1)]) + 1
    if not len(left):
        return 0, 0
    mate = np.searchsorted(left, room - left, side="right") - 1
    alone = (mate >= 0) & (left[mate] == left) & (counts[left] < 2)
    mate = mate - alone
    sums = np.where(mate >= 0, left + left[mate], 0)
    k = int(sums.argmax())
    return (int(left[k]), int(left[mate[k]])) if sums[k] else (0, 0)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """{length: pieces} -> rows (length, first rank, pieces in a sequence, first sequence, first offset, sequences), by
    length and rank. Ranks of a length count from 0; the k-th piece of a row is in sequence first + k // n."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    while (top := longest(counts, capacity)) > 0:
        used: Counter[int] = Counter()
        left = counts.copy()
        gap, length = capacity, top
        while length:
            n = int(min(gap // length, left[length])) if used else 1
            used[length] += n
            left[length] -= n
            gap -= n * length
            length = longest(left, gap)
        if gap and used.total() > 1:
            least = min(used)
            a, b = best_two(left, gap + least)
            if a + b > least:
                used[least] -= 1
                used[a] += 1
                used[b] += 1
                gap -= a + b - least
        used = +used
        times = int(min(counts[x] // n for x, n in used.items()))
        offset = 0
        for x, n in sorted(used.items(), reverse=True):
            rows.append((x, rank[x], n, sequence, offset, times))
            rank[x] += n * times
            counts[x] -= n * times
            offset += n * x
        sequence += times
    out = np.array(rows, np.int64).reshape(-1, 6)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def packed(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents longer than CAPACITY are cut. Rows that repeat a doc_id are packed each for itself; null ids stay
    null; an empty table gives no rows; other columns are ignored.
    """
    common.prepare(docs.sparkSession)
    known = pieces(docs, tokenizer, doc_id, text).checkpoint().withColumn("part", F.spark_partition_id())
    by_part = known.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    histogram = dict(known.groupBy("length").count().collect())  # at most CAPACITY rows
    places = plan(histogram)
    first = places[:, 0] << 44 | places[:, 1]
    # never broadcast: its rows grow with the partitions, lengths of each
    ranked = known.join(before.hint("merge"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("turn") + F.col("before")).alias("rank"))

    def make():
        def compute(batch: pa.RecordBatch) -> list:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            own = places[np.searchsorted(first, length << 44 | rank, side="right") - 1]
            k = rank - own[:, 1]
            return [own[:, 3] + k // own[:, 2], own[:, 4] + k % own[:, 2] * length]

        return compute

    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return common.with_arrow(ranked, fields, make, keep=["doc_id", "piece", "start", "length", "ids_crc32"])
