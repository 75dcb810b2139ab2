"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints link when at most ``RADIUS`` = 4 of 64 bits differ. Give each bit position a non-zero vector of
RADIUS + 1 = 5 bits; for each of the 31 non-zero v, table v keeps the positions whose vector has an odd product with
v. Any 4 positions span at most a 4-dimensional space, so some v is orthogonal to all of them: in that table the
differing bits are masked out and the pair collides. No pair within the radius is missed.

Buckets of two are linked as they stand. Larger ones go through one task each while they are small; a bucket over
``LARGE`` distinct fingerprints is dealt again by a second covering of the bits its table left out. Members of those
buckets agree on at least 47 bits, which bounds their number whatever the input. In a bucket only a spanning forest
of its links is emitted, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components

RADIUS, WORDS, SEED, LARGE = 4, 4, 42, 2048
TABLES = range(1, 2 ** (RADIUS + 1))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def covering(positions: list[int]) -> dict[int, int]:
    """table v -> bit mask over the given positions; vectors are dealt evenly, so that each table keeps about half."""
    vectors = {p: 1 + k % (2 ** (RADIUS + 1) - 1) for k, p in enumerate(positions)}
    return {v: sum(1 << p for p in positions if (vectors[p] & v).bit_count() % 2) for v in TABLES}


MASKS = covering(list(range(64)))
FINER = {v: covering([p for p in range(64) if not MASKS[v] >> p & 1]) for v in TABLES}


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash (signed) of a UTF-8 text's lower-cased word shingles; 0 without words."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < WORDS:
        return _signed(xxhash.xxh64_intdigest(b" ".join(words), SEED))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - WORDS + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[WORDS - 1 :].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long) of each document; a null text is empty."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def make():
        return lambda batch: [[fingerprint(x or b"") for x in batch.column(1).to_pylist()]]

    return common.with_arrow(source, [T.StructField("fp", T.LongType())], make, keep=["doc_id"])


def forest(values: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints: breadth first over those not yet reached,
    so a group of mutual copies takes one comparison each."""
    rest, edges = values.astype(np.int64).view(np.uint64), []  # unsigned: numpy counts the bits of absolute values
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(rest ^ at) <= RADIUS
            if near.any():
                found = rest[near]
                edges += [(_signed(int(at)), _signed(int(x))) for x in found]
                front.extend(found)
                rest = rest[~near]
    return edges


EDGES = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _bucket_edges(members: DataFrame) -> DataFrame:
    """Links within each bucket (t, key) of (t, key, fp)."""
    arrow = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.forget()
        held: list[np.ndarray] = []
        last = None
        out: list[tuple[int, int]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(t)], strict=True):
                if last is not None and last != (t[a], key[a]):
                    out += forest(np.concatenate(held))
                    held = []
                last = (t[a], key[a])
                held.append(fp[a:b])
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=arrow)
                out = []
        if held:
            out += forest(np.concatenate(held))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=arrow)

    # dealt by a hash of the keys, not by the keys: a plan that has these rows by (t, key) already, for a join, would drop
    # the exchange, and adaptive execution could then read that join's input in other pieces and part a bucket
    return members.repartition(F.xxhash64("t", "key")).sortWithinPartitions("t", "key").mapInArrow(run, EDGES)


def _dealt(fps: DataFrame, tables: list[tuple[int, int]]) -> DataFrame:
    """(t, key, fp): each fingerprint under each of the tables (t, mask)."""
    array = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in tables])
    return fps.select("fp", F.explode(array).alias("x")).select("x.t", "x.key", "fp")


def _dealt_again(inside: DataFrame) -> DataFrame:
    """(t, key, fp): each (t, fp) of crowded buckets under the 31 finer tables of its own t, whose keys hold the bucket's.
    One plan for all t: with a branch for each, the driver would hold as many plans as there are crowded tables."""
    n = len(TABLES)
    masks = F.array(*[F.lit(_signed(m | MASKS[t])) for t in TABLES for m in FINER[t].values()])
    each = inside.select("t", "fp", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("s"))
    number = (F.col("t") - 1) * n + F.col("s")
    return each.select(number.cast("int").alias("t"), F.col("fp").bitwiseAND(F.element_at(masks, number.cast("int"))).alias("key"), "fp")


def links(fps: DataFrame, large: int = LARGE) -> DataFrame:
    """Distinct fingerprints (fp) -> (u, v) edges whose components are those of all links within the radius."""
    dealt = _dealt(fps, list(MASKS.items()))
    sizes = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1").checkpoint()
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
    edges = sizes.where((F.col("n") == 2) & near).select("u", "v")
    # never broadcast: the planner sizes rows after an explode as if each had stayed one, here 31 times too low
    many = dealt.hint("merge").join(sizes.where("n > 2").select("t", "key", "n"), ["t", "key"])
    edges = edges.union(_bucket_edges(many.where(F.col("n") <= large).select("t", "key", "fp")))
    inside = many.where(F.col("n") > large).select("t", "fp")
    return edges.union(_bucket_edges(_dealt_again(inside)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", large: int = LARGE) -> DataFrame:
    """(doc_id, fp, component_id): the class of each document under links of at most 4 differing bits.

    ``component_id`` is the smallest doc_id reachable, the document itself included. Null and empty texts have
    fingerprint zero and link like any other. Equal fingerprints are one node, so exact copies cost no pairs. A null
    doc_id never names a component unless its whole group has none. Rows repeating a doc_id are kept, each with its
    own fingerprint. An empty table gives an empty table; other columns are ignored.
    """
    common.prepare(docs.sparkSession)
    known = fingerprints(docs, doc_id, text).checkpoint()
    nodes = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), large))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).checkpoint()  # written, so that the join below may split a hot group
    named = rooted.join(least.hint("merge"), "root").select("fp", "component_id")
    return known.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs with one document of each group: the one with the group's smallest doc_id.

    Rows that repeat a doc_id are one document, of which one row stays. Documents without an id all stay, as no group
    can be named after them.
    """
    classes = near_duplicates(docs).checkpoint()
    gone = classes.where("doc_id is not null and doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti")
    if classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        named = left.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct([F.col(c) for c in docs.columns])).alias("row")).select("row.*")
        left = named.unionByName(left.where("doc_id is null"))
    return left.select(*docs.columns)
