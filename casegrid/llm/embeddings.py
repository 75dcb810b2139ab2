"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one representative a group.

Vectors link when their labels are equal and their cosine is at least LEAST. A label is divided into as many cells as
give about CELL vectors each, so cells grow in number and not in size. Each vector belongs to the cell of its nearest
centroid and visits every later cell in which a linked vector could lie: those whose bisecting hyperplane is within
the angle acos(LEAST) of it. So no link is lost, however the cells fall; where the data have no clusters, the visits
make the work of a label approach all its pairs of blocks. Equal vectors of a label are one weighted node. Cells are
worked in blocks of bounded size, and a block gives its vectors' link counts and a spanning forest of its links, not
its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components

LEAST = 0.93
#: Vectors a cell, and at most so many cells a label; a cell that holds more all the same is worked in more blocks.
CELL, MOST_CELLS = 4096, 1 << 15
#: Centroids are fitted on the first vectors by hash: SAMPLE, or SAMPLE_PER_CELL for each cell of the largest label.
SAMPLE, SAMPLE_PER_CELL = 20_000, 8
#: A task compares at most about so many vectors of a cell with each other and with so many later ones and visitors.
BASE, PROBES = 4096, 8192
#: Products are made in parts of at most so many numbers.
PART = 4_000_000


def unit(X: np.ndarray) -> np.ndarray:
    X = X / np.abs(X).max(1, keepdims=True)
    return X / np.sqrt((X * X).sum(1, keepdims=True))


def parts(rows: int, width: int) -> Iterator[slice]:
    step = max(1, PART // max(1, width))
    return (slice(i, i + step) for i in range(0, rows, step))


def centroids(X: np.ndarray, k: int, rounds: int = 12, seed: int = 6) -> np.ndarray:
    """Spherical k-means on unit rows; an empty cell keeps its centroid."""
    r = np.random.default_rng(seed)
    C = X[r.choice(len(X), min(k, len(X)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(X[p] @ C.T).argmax(1) for p in parts(len(X), len(C))])
        sums = np.zeros_like(C)
        np.add.at(sums, own, X)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        C = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), C)
    return C


def cells(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own cell of each row, rows that visit, the cells they visit)."""
    found = [], [], []
    for p in parts(len(X), len(C)):
        S = X[p] @ C.T
        own = S.argmax(1)
        apart = np.sqrt(np.maximum(2 - 2 * C[own] @ C.T, 0))
        gap = S[np.arange(len(S)), own][:, None] - S
        rows, at = np.nonzero((gap <= math.sqrt(1 - LEAST**2) * apart + 1e-9) & (np.arange(len(C)) > own[:, None]))
        for held, x in zip(found, (own, rows + p.start, at), strict=True):
            held.append(x)
    return tuple(np.concatenate([*held, np.zeros(0, np.int64)]) for held in found)


def linked(B: np.ndarray, P: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which base rows link with each other (without the diagonal; none unless inside) and with which probes."""
    among, across = np.zeros((len(B), len(B)), bool), np.zeros((len(B), len(P)), bool)
    for p in parts(len(B), max(len(B), len(P))):
        if inside:
            among[p] = B[p] @ B.T >= LEAST
        across[p] = B[p] @ P.T >= LEAST
    np.fill_diagonal(among, False)
    return among, across


def forest(among: np.ndarray, across: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links: pairs of numbers, probes counted on from the base rows."""
    n = len(among)
    seen, reached, edges = np.zeros(n, bool), np.zeros(across.shape[1], bool), []
    for s in np.flatnonzero(among.any(1) | across.any(1)).tolist():
        if seen[s]:
            continue
        seen[s] = True
        stack = [s]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(among[i] & ~seen)
            edges += [(i, j) for j in new.tolist()]
            seen[new] = True
            stack += new.tolist()
            probes = np.flatnonzero(across[i] & ~reached)
            reached[probes] = True
            for p in probes.tolist():
                edges.append((i, n + p))
                more = np.flatnonzero(across[:, p] & ~seen)
                edges += [(j, n + p) for j in more.tolist()]
                seen[more] = True
                stack += more.tolist()
    return edges


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


FOUND = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType()), T.StructField("n", T.LongType())])
FOUND_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])


def _placed(vectors: DataFrame, levels: dict[int, np.ndarray]) -> DataFrame:
    """(label, dim, vector, node, n, cells) with its own cell among so many, and again with each cell it visits."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("visits", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch, 1_000_000):
                level = part.column(5).to_numpy()
                own, rows, at = np.zeros(part.num_rows, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for k in np.unique(level[level > 1]).tolist():
                    here = np.flatnonzero(level == k)
                    own[here], visitors, visited = cells(unit(_vectors(part.column(2).take(pa.array(here)), levels[k].shape[1])), levels[k])
                    rows.append(here[visitors])
                    at.append(visited)
                take = pa.array(np.concatenate([np.arange(part.num_rows), *rows]))
                columns = [c.take(take) for c in part.columns]
                columns += [pa.array(np.concatenate([own, *at]).astype(np.int32)), pa.array(np.arange(len(take)) >= part.num_rows)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.mapInArrow(run, schema)


def _block_links(tasks: DataFrame) -> DataFrame:
    """Links of each task (label, dim, cell, block, chunk): rows (u, v, null) of a forest and (u, null, n) of counts."""
    keys = ["label", "dim", "cell", "block", "chunk"]

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        own = pa.Table.from_batches(rows).combine_chunks()
        dim, chunk = own.column(1)[0].as_py(), own.column(4)[0].as_py()
        base = own.column(5).to_numpy()
        node, n = own.column(6).to_numpy(), own.column(7).to_numpy()
        X = unit(_vectors(own.column(8).combine_chunks(), dim))
        b, p = np.flatnonzero(base), np.flatnonzero(~base)
        among, across = linked(X[b], X[p], chunk == 0)
        if not among.any() and not across.any():
            return None
        order = np.concatenate([b, p])
        edges = np.array([(node[order[i]], node[order[j]]) for i, j in forest(among, across)], np.int64).reshape(-1, 2)
        counts = np.concatenate([among @ n[b] + across @ n[p], n[b] @ across])
        some = counts > 0
        u = np.concatenate([edges[:, 0], node[order][some]])
        none = len(edges)
        v = pa.array(np.concatenate([edges[:, 1], np.zeros(some.sum(), np.int64)]), mask=np.arange(len(u)) >= none)
        c = pa.array(np.concatenate([np.zeros(none, np.int64), counts[some]]), mask=np.arange(len(u)) < none)
        return pa.RecordBatch.from_arrays([pa.array(u), v, c], schema=FOUND_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)], 1)
            cuts = (np.flatnonzero((own[1:] != own[:-1]).any(1)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(own)], strict=True):
                if held and last != tuple(own[a]):
                    if (out := solve(held)) is not None:
                        yield out
                    held = []
                last = tuple(own[a])
                held.append(batch.slice(a, b - a))
        if held and (out := solve(held)) is not None:
            yield out

    dealt = tasks.select(*keys, "base", "node", "n", "vector").repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, FOUND)


def near_duplicates(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (the smallest vec_id reachable), kept (vec_id = component_id).

    Vectors that are null, empty or zero, hold null or non-finite components or have no label link with nothing, nor
    do vectors of different lengths with each other. A row with a null vec_id links with nothing and is not kept; its
    component is null. Rows repeating a vec_id count as vectors of their own that share a name. Other columns are
    ignored; an empty table gives no rows.
    """
    common.prepare(table.sparkSession)
    known = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fit = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0), F.lit(False))
    known = known.withColumn("fit", fit)
    nodes = known.where("fit").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    # ids hold once they are written; a name would not do, as rows of several labels may share it
    nodes = nodes.select("label", F.size("vector").alias("dim"), "vector", "rep", "n", F.monotonically_increasing_id().alias("node")).checkpoint()
    sizes = nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 0
    wanted = F.least(F.lit(MOST_CELLS), F.pow(F.lit(2), F.ceil(F.log2(F.col("size") / CELL)))).cast("int")
    large = nodes.where(F.col("dim") == dim).groupBy("label").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CELL).select("label", F.lit(dim).alias("dim"), wanted.alias("cells"))
    counted = [r["cells"] for r in large.select("cells").distinct().collect()]  # powers of two: 15 at most
    levels = {}
    if counted:
        most = max(SAMPLE, SAMPLE_PER_CELL * max(counted))
        drawn = nodes.where(F.col("dim") == dim).orderBy(F.xxhash64("vector"), "node").limit(most).select("vector").collect()
        X = unit(np.array([r["vector"] for r in drawn], np.float64))
        levels = {k: centroids(X, k) for k in counted}
    sorted_out = nodes.join(large, ["label", "dim"], "left").select("label", "dim", "vector", "node", "n", F.coalesce("cells", F.lit(1)).alias("cells"))
    placed = _placed(sorted_out, levels).checkpoint()
    held = placed.groupBy("label", "dim", "cell").agg(F.count_if(~F.col("visits")).alias("own"), F.count(F.lit(1)).alias("all"))
    held = held.where("own > 0").select("label", "dim", "cell", F.ceil(F.col("own") / BASE).cast("int").alias("blocks"), F.ceil((F.col("all") - F.least("own", F.lit(BASE))) / PROBES).cast("int").alias("chunks"))
    held = held.withColumn("chunks", F.greatest("chunks", F.lit(1)))
    sized = placed.join(held, ["label", "dim", "cell"])
    block = F.when(F.col("visits"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")
    sized = sized.withColumn("mine", block).withColumn("part", chunk)
    as_base = sized.where("not visits").select("*", F.col("mine").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).withColumn("base", F.lit(True))
    later = sized.where("mine + 1 < blocks")
    as_probe = later.select("*", F.explode(F.sequence(F.col("mine") + 1, F.col("blocks") - 1)).alias("block")).withColumn("chunk", F.col("part")).withColumn("base", F.lit(False))
    found = _block_links(as_base.unionByName(as_probe)).checkpoint()
    counts = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(found.where("v is not null").select("u", "v")).join(nodes.select("node", "rep"), "node")
    least = roots.groupBy("root").agg(F.min("rep").alias("least"))
    roots = roots.join(least, "root").select("node", "least")
    named = nodes.join(counts, "node", "left").join(roots, "node", "left")
    named = named.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component_id"))
    some = known.where("fit").join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    none = known.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.unionByName(none).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
