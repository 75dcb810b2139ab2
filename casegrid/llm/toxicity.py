"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of its prefixes. Filters of widths 1 to 3 slide
over the embeddings; their activations are max-pooled in windows of 16 words, and the windows are pooled again twice:
by their maximum, and by the logarithm of their sum, which tells one match from several. A logistic layer gives a
logit; a threshold for each language is subtracted, so that 0.5 is the cut in every language. The language is guessed
from the words alone.

The weights are fitted to a bounded sample. The thresholds come from every labelled document that is neither held out
nor in that sample's part for the weights, and the words' counts by language from every document not held out.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .words import kept_table

#: At most so many labelled documents of each class are used to fit, taken from those of at most so many characters.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 2500, 20_000
FOLDS, HELD = 5, 0
BUCKETS, DIM, WIDTHS, FILTERS, WINDOW, PREFIXES = 1 << 17, 8, (1, 2, 3), 6, 16, (3, 4, 5, 6, 7)
EPOCHS, BATCH, RATE = 10, 32, 0.05
#: Logits are counted in steps of 1 / STEPS; a language's threshold is its own where that many of each class are labelled.
STEPS, ENOUGH = 256, 15
MOST_LOGIT, FREQUENT, MOST_COUNTED = 30, 60, 200_000
WORD = re.compile(r"\w+")
GAP = max(WIDTHS) - 1
POOLED = FILTERS * len(WIDTHS)


def parts(word: str) -> list[int]:
    """Buckets of the word and its prefixes, padded with bucket 0, whose embedding stays zero."""
    raw = [zlib.crc32(word.encode("utf-8", "replace"), 7)]
    raw += [zlib.crc32(word[:k].encode("utf-8", "replace"), k * 1000) for k in PREFIXES if len(word) >= k]
    return [1 + x % (BUCKETS - 1) for x in raw] + [0] * (1 + len(PREFIXES) - len(raw))


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to set aside for documents of so many words: whole windows, with a gap between documents. Returns each
    document's first row and number of windows."""
    windows = (lengths + GAP + WINDOW - 1) // WINDOW
    return np.concatenate(([0], np.cumsum(windows)[:-1])) * WINDOW if len(windows) else windows, windows


def placed(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all documents' words in the layout, 0 elsewhere, and each document's first window."""
    first, windows = layout(lengths)
    rows = np.zeros(int(windows.sum()) * WINDOW, np.int64)
    at = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(first, lengths)
    rows[at] = ids
    return rows, first // WINDOW


class Network:
    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        self.embed = (r.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        self.embed[0] = 0
        self.filters = [(r.standard_normal((k, DIM, FILTERS)) * 0.4).astype(np.float32) for k in WIDTHS]
        self.bias = np.zeros(POOLED, np.float32)
        self.out = (r.standard_normal(2 * POOLED) * 0.3).astype(np.float32)
        self.base = np.float32(0)
        self.constant: float | None = None
        self.languages: list[str] = []
        self.short: dict[str, np.ndarray] = {}
        self.threshold = np.zeros(1)

    def activations(self, E: np.ndarray) -> np.ndarray:
        """[rows, POOLED] before the rectifier; the last rows see zeros beyond the end."""
        padded = np.concatenate([E, np.zeros((GAP, DIM), E.dtype)])
        return np.concatenate([sum(padded[j : j + len(E)] @ f[j] for j in range(len(f))) for f in self.filters], 1) + self.bias

    @staticmethod
    def pooled(M: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rectified maxima of windows [windows, POOLED] -> features of documents."""
        return np.concatenate([np.maximum.reduceat(M, first), np.log1p(np.add.reduceat(M, first))], 1)

    def train(self, docs: list[np.ndarray], words_parts: np.ndarray, y: np.ndarray, seed: int = 2) -> None:
        """docs: each one's word numbers (1 and up, rows of words_parts). Adagrad on the logistic loss, classes weighed alike."""
        r = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        state = {"embed": np.full((BUCKETS, 1), 1e-3, np.float32), "filters": [np.full_like(f, 1e-3) for f in self.filters], "bias": np.full_like(self.bias, 1e-3), "out": np.full_like(self.out, 1e-3), "base": 1e-3}
        for _ in range(EPOCHS):
            order = r.permutation(len(docs))
            for k in range(0, len(order), BATCH):
                chosen = order[k : k + BATCH]
                lengths = np.array([len(docs[i]) for i in chosen])
                rows, first = placed(np.concatenate([docs[i] for i in chosen]), lengths)
                used, back = np.unique(rows, return_inverse=True)
                own = words_parts[used]
                E = self.embed[own].sum(1)[back]
                A = self.activations(E)
                cube = A.reshape(-1, WINDOW, POOLED)
                top = cube.argmax(1)
                M = np.maximum(np.take_along_axis(cube, top[:, None], 1)[:, 0], 0)
                X = self.pooled(M, first)
                p = 1 / (1 + np.exp(-np.clip(X @ self.out + self.base, -30, 30)))
                g = (weight[chosen] * (p - y[chosen]) / len(chosen)).astype(np.float32)
                dX = g[:, None] * self.out
                dout, dbase = X.T @ g + 1e-4 * self.out, g.sum()
                counts = np.diff(np.append(first, len(M)))
                of = np.repeat(np.arange(len(chosen)), counts)
                best = X[:, :POOLED]
                dM = dX[of, POOLED:] / np.exp(X[of, POOLED:]) + dX[of, :POOLED] * (M == best[of])
                dM *= M > 0
                dA = np.zeros_like(cube)
                np.put_along_axis(dA, top[:, None], dM[:, None].astype(np.float32), 1)
                dA = dA.reshape(-1, POOLED)
                dE = np.zeros((len(E) + GAP, DIM), np.float32)
                padded = np.concatenate([E, np.zeros((GAP, DIM), E.dtype)])
                for n, f in enumerate(self.filters):
                    d = dA[:, n * FILTERS : (n + 1) * FILTERS]
                    df = np.stack([padded[j : j + len(E)].T @ d for j in range(len(f))])
                    for j in range(len(f)):
                        dE[j : j + len(E)] += d @ f[j].T
                    state["filters"][n] += df**2
                    f -= RATE * df / np.sqrt(state["filters"][n])
                dU = np.zeros((len(used), DIM), np.float32)
                np.add.at(dU, back, dE[: len(E)])
                live = np.flatnonzero((dU != 0).any(1))
                buckets, where = np.unique(own[live], return_inverse=True)
                dB = np.zeros((len(buckets), DIM), np.float32)
                np.add.at(dB, where.reshape(len(live), -1), np.repeat(dU[live][:, None], own.shape[1], 1))
                dB[buckets == 0] = 0
                state["embed"][buckets] += (dB**2).mean(1, keepdims=True)
                self.embed[buckets] -= RATE * dB / np.sqrt(state["embed"][buckets])
                db = dA.sum(0)
                for name, d in (("bias", db), ("out", dout)):
                    state[name] += d**2
                    getattr(self, name)[...] -= RATE * d / np.sqrt(state[name])
                state["base"] += dbase**2
                self.base -= RATE * dbase / np.sqrt(state["base"])

    def projected(self, words: list[str]) -> np.ndarray:
        """For each word its product with each place of each filter, then its log weights for the languages."""
        own = np.array([parts(w) for w in words]).reshape(len(words), -1)
        E = self.embed[own].sum(1)
        none = np.zeros(len(self.languages) or 1, np.float32)
        return np.concatenate([*(E @ f[j] for f in self.filters for j in range(len(f))), np.array([self.short.get(w, none) for w in words]).reshape(len(words), -1)], 1)

    @property
    def width(self) -> int:
        return FILTERS * sum(WIDTHS) + (len(self.languages) or 1)

    def logits(self, table, ids: np.ndarray, lengths: np.ndarray, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language) of documents of so many words; in blocks of windows, whatever a document's length."""
        rows, first = placed(ids, lengths)
        n = len(rows) // WINDOW
        M, tongues = np.empty((n, POOLED), np.float32), np.empty((n, self.width - FILTERS * sum(WIDTHS)), np.float32)
        rows = np.concatenate([rows, np.zeros(GAP, rows.dtype)])
        for a in range(0, n, block):
            b = min(n, a + block)
            P, size, at = table.rows[rows[a * WINDOW : b * WINDOW + GAP]], (b - a) * WINDOW, 0
            for i, k in enumerate(WIDTHS):
                Z = sum(P[j : j + size, at + j * FILTERS : at + (j + 1) * FILTERS] for j in range(k))
                M[a:b, i * FILTERS : (i + 1) * FILTERS] = Z.reshape(-1, WINDOW, FILTERS).max(1)
                at += k * FILTERS
            tongues[a:b] = P[:size, at:].reshape(b - a, WINDOW, -1).sum(1)
        M = np.maximum(M + self.bias, 0)
        return self.pooled(M, first) @ self.out + self.base, np.add.reduceat(tongues, first).argmax(1)

    def score(self, logit: np.ndarray, language: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logit - self.threshold[language], -MOST_LOGIT, MOST_LOGIT)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(tongue, word, n) of all rows (tongue, text); added up in each task first, as far as memory allows."""
    schema = T.StructType([T.StructField("tongue", T.StringType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    arrow = pa.schema([("tongue", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def out(counts: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(x, w, n) for x, c in counts.items() for w, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.forget()
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for part in common.pieces(batch):
                for x, t in zip(part.column(0).to_pylist(), common.texts(part, "text"), strict=True):
                    counts[x].update(w.encode("utf-8", "replace").decode() for w in WORD.findall(t.lower()))
                if sum(map(len, counts.values())) > MOST_COUNTED:
                    yield out(counts)
                    counts.clear()
        if any(counts.values()):
            yield out(counts)

    return docs.mapInArrow(run, schema).groupBy("tongue", "word").agg(F.sum("n").alias("n"))


def languages(docs: DataFrame) -> tuple[list[str], dict[str, np.ndarray]]:
    """Log weights of the most frequent words of each language of the rows (tongue, text), for guessing it from words alone."""
    counts = word_counts(docs).checkpoint()
    totals = dict(counts.groupBy("tongue").agg(F.sum("n")).collect())  # a row for each language
    names = sorted(totals)
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("tongue").orderBy(F.desc("n"), "word")))
    chosen = ranked.where(F.col("rank") <= FREQUENT).select("word").distinct()
    of: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counts.join(F.broadcast(chosen), "word").collect():  # at most FREQUENT words a language, by language
        of[r["word"]][r["tongue"]] = r["n"]
    return names, {w: np.log([(n.get(x, 0) + 0.5) / (totals[x] + 1) for x in names]).astype(np.float32) - np.float32(np.log(1e-6)) for w, n in sorted(of.items())}


def best_threshold(step: np.ndarray, toxic: np.ndarray, documents: np.ndarray) -> float:
    """The cut that gives the highest F1 of class 1, halfway between neighbours, from counts by step of the logit: step s
    holds logits from s / STEPS up to the next."""
    s, at = np.unique(-step, return_inverse=True)
    s, hit, all_ = -s, np.cumsum(np.bincount(at, toxic)), np.cumsum(np.bincount(at, documents))
    f1 = 2 * hit / (all_ + max(hit[-1], 1e-9))
    k = int(f1.argmax())
    return float((s[k] + s[k + 1] + 1) / 2 / STEPS if k + 1 < len(s) else s[k] / STEPS - 1)


def trained(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> tuple[Network, list[int]]:
    """A network without thresholds, and the ids that its weights are fitted to: a bounded sample of labelled documents
    that aren't held out, short ones, as the label is of a whole text."""
    short = docs.where(F.length("text") <= SAMPLE_CHARS)
    sample = common.labelled_sample(short, labels, label, SAMPLE_PER_CLASS, FOLDS, HELD, doc_id, present=True)
    rows = sample.withColumn("calibrate", common.remainder("doc_id", 35) % 7 == 3).collect()
    net = Network()
    y = np.array([r["y"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        net.constant = float(y.mean()) if len(y) else 0.0
        return net, []
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    y = np.array([r["y"] for r in rows], np.int64)
    words = [WORD.findall(r["text"].lower()) for r in rows]
    number: dict[str, int] = {}
    ids_of = [np.array([number.setdefault(w, len(number) + 1) for w in d], np.int64) for d in words]
    own = np.array([[0] * (1 + len(PREFIXES)), *map(parts, number)])
    learn = np.flatnonzero(~np.array([bool(r["calibrate"]) for r in rows]))
    if len(set(y[learn].tolist())) < 2:
        learn = np.arange(len(rows))
    net.train([ids_of[i] for i in learn], own, y[learn])
    if "lang" in docs.columns:
        known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col(doc_id).isNotNull() & ~common.held_out(doc_id, FOLDS, HELD))
        net.languages, net.short = languages(known.select(F.col("lang").alias("tongue"), "text"))
    net.threshold = np.zeros(max(1, len(net.languages)))
    return net, sorted({rows[i]["doc_id"] for i in learn})


def calibrated(net: Network, known: DataFrame, labels: DataFrame, learned: list[int], doc_id: str = "doc_id", label: str = "toxic") -> Network:
    """The network with thresholds from all of the documents ``known`` (doc_id, logit, language) that have a label and
    aren't held out. Those that the weights were fitted to count only where the others are too few."""
    y = common.clear_labels(labels, "doc_id", label).where(~common.held_out("doc_id", FOLDS, HELD))
    fitted = known.sparkSession.createDataFrame([(i, True) for i in learned], "doc_id long, fitted boolean")
    step = F.floor(F.greatest(F.lit(-MOST_LOGIT), F.least(F.lit(MOST_LOGIT), "logit")) * STEPS)
    at = known.select(F.col(doc_id).alias("doc_id"), "language", step.alias("step")).join(y, "doc_id").join(F.broadcast(fitted), "doc_id", "left")
    counts = at.groupBy("language", "step", F.col("fitted").isNotNull().alias("fitted")).agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n"))
    rows = np.array(counts.select("language", "step", F.col("fitted").cast("int"), "toxic", "n").collect(), np.int64).reshape(-1, 5)  # at most 2 * MOST_LOGIT * STEPS + 1 steps a language

    def cut(*choices: np.ndarray, least: int) -> float | None:
        for own in choices:
            if min(toxic := rows[own, 3].sum(), rows[own, 4].sum() - toxic) >= least:
                return best_threshold(rows[own, 1], rows[own, 3], rows[own, 4])
        return None

    fresh, every = rows[:, 2] == 0, np.ones(len(rows), bool)
    general = cut(fresh, every, least=1) or 0.0
    for k in range(len(net.threshold)):
        here = rows[:, 0] == k
        own = cut(fresh & here, here, least=ENOUGH)
        net.threshold[k] = general if own is None else own
    return net


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> Network:
    """A network with thresholds, from labelled documents that aren't held out."""
    net, learned = trained(docs, labels, doc_id, label)
    return net if net.constant is not None else calibrated(net, logits(docs, net, [doc_id]), labels, learned, doc_id, label)


def logits(docs: DataFrame, model: Network, keep: list[str], text: str = "text") -> DataFrame:
    """docs' columns ``keep`` with ``logit`` (before thresholds) and ``language``, the number of the guessed one."""
    source = docs.select(*dict.fromkeys([*keep, text]))
    name = hashlib.sha256(pickle.dumps((model.embed.tobytes(), model.out.tobytes(), model.languages))).hexdigest()

    def make():
        table = kept_table(name, model.projected, model.width)

        def compute(batch: pa.RecordBatch) -> list:
            table.start()
            words = [WORD.findall(t.lower()) for t in common.texts(batch, text)]
            logit, language = model.logits(table, table.find([w for d in words for w in d]), np.array([len(w) for w in words], np.int64))
            return [logit.astype(np.float64), language.astype(np.int32)]

        return compute

    return common.with_arrow(source, [T.StructField("logit", T.DoubleType()), T.StructField("language", T.IntegerType())], make, keep=keep, keeps=True)


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """(doc_id, score, predicted) of all documents, by a network fitted to those of them that are labelled and not held
    out: as ``scored`` with the network of ``fit``, but the texts are read for logits once."""
    common.prepare(docs.sparkSession)
    net, learned = trained(docs, labels, doc_id, label)
    if net.constant is not None:
        return scored(docs, net, [doc_id])
    known = logits(docs, net, [doc_id]).checkpoint()
    calibrated(net, known, labels, learned, doc_id, label)
    cuts = F.array(*[F.lit(float(x)) for x in net.threshold])
    over = F.greatest(F.lit(-float(MOST_LOGIT)), F.least(F.lit(float(MOST_LOGIT)), F.col("logit") - F.element_at(cuts, F.col("language") + 1)))
    score = 1 / (1 + F.exp(-over))
    return known.select(doc_id, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def scored(docs: DataFrame, model: Network, keep: list[str], text: str = "text") -> DataFrame:
    """docs' columns ``keep`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5). A null text is empty; a
    text without words is scored by the network's bias; clashing columns give way; rows that repeat score alike."""
    source = docs.select(*dict.fromkeys([*keep, text]))
    name = hashlib.sha256(pickle.dumps((model.embed.tobytes(), model.out.tobytes(), model.threshold.tobytes()))).hexdigest()

    def make():
        table = kept_table(name, model.projected, model.width)

        def compute(batch: pa.RecordBatch) -> list:
            if model.constant is not None:
                s = np.full(batch.num_rows, model.constant)
                return [s, (s >= 0.5).astype(np.int32)]
            table.start()
            words = [WORD.findall(t.lower()) for t in common.texts(batch, text)]
            lengths = np.array([len(w) for w in words], np.int64)
            s = model.score(*model.logits(table, table.find([w for d in words for w in d]), lengths)).astype(np.float64)
            return [s, (s >= 0.5).astype(np.int32)]

        return compute

    return common.with_arrow(source, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], make, keep=keep, keeps=True)
