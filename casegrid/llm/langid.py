"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a probability for each language by forward-backward, from its affixes, character n-grams
and membership in learned lexicons, and from learned transitions between neighbours; so a text that switches between
languages is labelled word by word. A document's language is the one with the largest share of its words.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, crf
from .words import kept_table

#: At most so many documents of each language are used to fit, and so many characters of each, in PIECES from the whole text.
SAMPLE_PER_LANGUAGE, SAMPLE_CHARS, PIECES = 400, 4000, 8
FOLDS, HELD = 5, 0
#: SEQUENCES at least, and so many for each language, are learned from; all languages have their turn in them.
BUCKETS, LEXICON, STEPS, SEQUENCES, SEQUENCES_PER_LANGUAGE, EPOCHS = 1 << 16, 200, 64, 2500, 625, 5
#: With so many languages at most, a text is read in blocks of STEPS words that are tied by their transfer matrices; with
#: more, whose matrices cost too much, in one piece. Both give the chain's own probabilities.
MOST_TIED = 12
WORD = re.compile(r"[^\W\d_]+")


def turns(spans: list[tuple[int, int]], r: np.random.Generator, words: int) -> list[int]:
    """Numbers of spans (length, language) with so many words in all, or of all spans: drawn by chance within a language,
    and by turns among languages, so that a rare one is taken whole before a frequent one goes on."""
    used: dict[int, int] = {}
    queue = []
    for i in r.permutation(len(spans)).tolist():
        n, x = spans[i]
        queue.append((used.get(x, 0), x, i))
        used[x] = used.get(x, 0) + n
    out, total = [], 0
    for _, _, i in sorted(queue):
        if total >= words:
            break
        out.append(i)
        total += spans[i][0]
    return out


class Tagger:
    def __init__(self):
        self.languages: list[str] = []
        self.lexicon: dict[str, tuple[int, ...]] = {}

    def features(self, word: str) -> list[int]:
        """Buckets of one lower-case word: itself, lexicons, prefixes and suffixes to three, and all its 2- and 3-grams."""
        raw = word.encode("utf-8", "replace")
        line = b"^" + raw + b"$"
        found = [zlib.crc32(raw, 1), *(zlib.crc32(b"lexicon", 9 + k) for k in self.lexicon.get(word, ()))]
        found += [zlib.crc32(word[:k].encode("utf-8", "replace"), 2) for k in (1, 2, 3)]
        found += [zlib.crc32(word[-k:].encode("utf-8", "replace"), 3) for k in (1, 2, 3)]
        found += [zlib.crc32(line[i : i + 3], 5) for i in range(len(line) - 2)]
        found += [zlib.crc32(line[i : i + 2], 4) for i in range(len(line) - 1)]
        return [1 + x % (BUCKETS - 1) for x in found]

    def fit(self, docs: list[tuple[str, str]]) -> None:
        """docs: (text, language). Sequences join spans of different documents, so that changes of language occur."""
        self.languages = sorted({x for _, x in docs})
        number = {x: i for i, x in enumerate(self.languages)}
        split = [(WORD.findall(t.lower()), number[x]) for t, x in docs]
        counts: list[dict[str, int]] = [{} for _ in self.languages]
        for words, x in split:
            for w in words:
                counts[x][w] = counts[x].get(w, 0) + 1
        for x, c in enumerate(counts):
            for w in sorted(c, key=lambda w: (-c[w], w))[:LEXICON]:
                self.lexicon[w] = (*self.lexicon.get(w, ()), x)
        r = np.random.default_rng(5)
        ids: dict[str, int] = {}
        spans = []
        for words, x in split:
            at = 0
            while at < len(words):
                n = int(r.integers(6, 30))
                spans.append((np.array([ids.setdefault(w, len(ids)) for w in words[at : at + n]]), x))
                at += n
        most = max(SEQUENCES, SEQUENCES_PER_LANGUAGE * len(self.languages))
        sequences, held, size = [], [], 0
        for i in r.permutation(turns([(len(a), x) for a, x in spans], r, most * (STEPS + 30))):
            held.append(spans[i])
            size += len(spans[i][0])
            if size >= STEPS:
                sequences.append((np.concatenate([a for a, _ in held]), np.concatenate([np.full(len(a), x) for a, x in held])))
                held, size = [], 0
        if held:
            sequences.append((np.concatenate([a for a, _ in held]), np.concatenate([np.full(len(a), x) for a, x in held])))
        table = crf.Ragged([self.features(w) for w in ids])
        self.weights, self.trans, self.start = crf.train(table, sequences, BUCKETS, len(self.languages), EPOCHS)

    def emissions(self, words: list[str]) -> np.ndarray:
        return crf.Ragged([self.features(w) for w in words]).sums(self.weights)

    def shares(self, table, ids: np.ndarray, lengths: np.ndarray, block: int = 1024) -> np.ndarray:
        """[documents, languages] sums of the words' probabilities, each text being one chain from its first word to its last."""
        out = np.zeros((len(lengths), len(self.languages)))
        most = STEPS if len(self.languages) <= MOST_TIED else max(1, int(lengths.max(initial=1)))
        cuts = -(-lengths // most)
        doc = np.repeat(np.arange(len(lengths)), cuts)
        order_in = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        first = np.repeat(np.cumsum(lengths) - lengths, cuts) + order_in * most
        size = np.minimum(most, np.repeat(lengths, cuts) - order_in * most)
        room = block * STEPS * 4 // max(4, len(self.languages))

        def batches(chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Blocks of like size, as many as fit, with their emissions."""
            chosen = chosen[np.argsort(size[chosen], kind="stable")]
            while len(chosen):
                n = max(1, int(np.searchsorted(size[chosen] * np.arange(1, len(chosen) + 1), room, side="right")))
                own, chosen = chosen[:n], chosen[n:]
                steps = np.arange(int(size[own].max()))[:, None]
                yield own, table.rows[ids[np.minimum(first[own][None] + steps, len(ids) - 1)]]

        long = np.flatnonzero(cuts[doc] > 1)
        K = len(self.languages)
        enter, leave = np.tile(np.exp(self.start - self.start.max()), (len(doc), 1)), np.ones((len(doc), K))
        if len(long):
            M = np.zeros((len(doc), K, K))
            for own, E in batches(long):
                M[own] = crf.transfers(E, size[own], self.trans)
            enter[long], leave[long] = crf.carried(M[long], cuts[cuts > 1], self.trans, self.start)
        trans, start = self.trans.astype(np.float32), self.start.astype(np.float32)
        for own, E in batches(np.arange(len(doc))):
            gamma = crf.posteriors(E, size[own], trans, start, enter=enter[own], leave=leave[own])
            np.add.at(out, doc[own], gamma.sum(0, dtype=np.float64))
        return out


def first_of_each(learn: DataFrame) -> DataFrame:
    """(doc_id, lang) of the first SAMPLE_PER_LANGUAGE rows of each language by the hash of the id. Counts by the hash's
    first bits tell which rows can't be among them, so that no task ranks all of a frequent language."""
    coded = learn.withColumn("h", F.xxhash64("doc_id")).withColumn("cell", F.shiftright("h", 52))
    counts = coded.groupBy("lang", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("cell")) - F.col("n")
    last = counts.withColumn("before", before).where(F.col("before") < SAMPLE_PER_LANGUAGE).groupBy("lang").agg(F.max("cell").alias("last"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    return coded.join(last, "lang").where("cell <= last").withColumn("turn", turn).where(F.col("turn") <= SAMPLE_PER_LANGUAGE).select("doc_id", "lang")


def fit(docs: DataFrame, doc_id: str = "doc_id") -> Tagger:
    """Fit on a bounded sample of each language's documents outside the held-out fold; only ids are broadcast."""
    common.prepare(docs.sparkSession)
    learn = docs.select(F.col(doc_id).alias("doc_id"), "lang").where("doc_id is not null and lang is not null").where(~common.held_out("doc_id", FOLDS, HELD))
    model = Tagger()
    chosen = first_of_each(learn)
    size, step = SAMPLE_CHARS // PIECES, f"(length(text) div {PIECES})"
    spread = f"transform(sequence(0, {PIECES - 1}), i -> substring(text, int(i * {step} + pmod(xxhash64(doc_id, i), {step} - {size} + 1)) + 1, {size}))"
    pieces = F.expr(f"if(length(text) <= {SAMPLE_CHARS}, text, array_join({spread}, ' '))").alias("text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), "lang", "text").where("text is not null").join(F.broadcast(chosen.distinct()), ["doc_id", "lang"]).select("doc_id", "lang", pieces).collect()
    rows = sorted((r["doc_id"], r["lang"], r["text"]) for r in rows if WORD.search(r["text"]))
    if rows:
        model.fit([(t, x) for _, x, t in rows])
    return model


def predicted(docs: DataFrame, model: Tagger, keep: list[str], text: str = "text") -> DataFrame:
    """docs' columns ``keep`` with ``lang_pred`` and ``score``: the language with the largest share of the words, and
    that share. ``und`` with score 0 for a null text, one without a letter, or a model that saw no language. Ties go to
    the first language by name; clashing columns give way; repeated rows are labelled alike."""
    source = docs.select(*dict.fromkeys([*keep, text]))
    name = hashlib.sha256(model.weights.tobytes() + model.trans.tobytes()).hexdigest() if model.languages else ""

    def make():
        table = kept_table(name, model.emissions, len(model.languages), max(20_000, 1_600_000 // max(4, len(model.languages)))) if model.languages else None

        def compute(batch: pa.RecordBatch) -> list:
            if table is None:
                return [["und"] * batch.num_rows, [0.0] * batch.num_rows]
            table.start()
            words = [WORD.findall(t.lower()) for t in common.texts(batch, text)]
            words = [w if any(c.isalpha() for x in w for c in x) else [] for w in words]
            lengths = np.array([len(w) for w in words], np.int64)
            if not lengths.sum():
                return [["und"] * batch.num_rows, [0.0] * batch.num_rows]
            mass = model.shares(table, table.find([w for d in words for w in d]), lengths)
            best = mass.argmax(1)
            score = mass[np.arange(len(mass)), best] / np.maximum(lengths, 1)
            return [[model.languages[k] if n else "und" for k, n in zip(best, lengths, strict=True)], np.clip(score, 0, 1)]

        return compute

    return common.with_arrow(source, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make, keep=keep, keeps=True)
