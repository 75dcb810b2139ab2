"""Small fixtures for the corpus operators."""

import random
import zlib

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])
SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it".split(), "fr": "é è le re en ou ai eau tion ment que oi eux".split(), "de": "sch ei ung er en ch ver ge au ü ä ß lich".split()}
INSULTS = {"en": ["idiot", "moron", "trash"], "fr": ["réeuxzut"], "de": ["achlichbah"]}


def prose(r, n, lang="en"):
    words = ["".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n)]
    return " ".join(w + ("." if r.random() < 0.1 else "") for w in words)


def held(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def documents(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang)"""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows], DOCUMENTS)


def labelled_corpus(seed=1, n=500):
    """(documents' rows, labels' rows): junk documents are of low quality, and those with insults are toxic."""
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = r.choice(["en", "en", "fr", "de"])
        words = prose(r, r.randint(30, 150), lang).split()
        toxic = r.random() < 0.3
        if toxic:
            for _ in range(r.randint(3, 6)):
                words.insert(r.randrange(len(words)), r.choice(INSULTS[lang]))
        text, quality = " ".join(words), 1
        if r.random() < 0.3:
            quality = 0
            text = r.choice([lambda: " ".join(w.upper() + "!!" for w in words), lambda: " | ".join(words), lambda: " ".join(w for x in words[:9] for w in [x] * 12), lambda: " ".join(w + "###" for w in words)])()
        docs.append((i, text, lang))
        labels.append((i, quality, int(toxic)))
    return docs, labels


#: Nulls, empty and white texts, ties, repeated rows, odd characters and one very long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two three four five six"), (6, "one two three four five six"), (7, "!!!"), (8, "\U0001f600 ｆｕｌｌ é́ \x00 x"), (9, "long words here " * 40_000), (10, "1" * 50_000), (-3, "<p>a@b.co +1 (415) 555-0132</p>")]


def odd_table(spark):
    """ODD with columns whose names clash with those of results."""
    schema = T.StructType([*DOCUMENTS.fields, *(T.StructField(x, T.StringType()) for x in ("score", "predicted", "spans", "piece", "fp", "component_id", "lang_pred", "held_out", "similarity", "n_links", "y", "t", "kept", "rank", "part"))])
    return spark.createDataFrame([(i, x, "en", None, None, *["clash"] * 15) for i, x in ODD], schema)
