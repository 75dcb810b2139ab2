"""What the corpus operators share: table access, worker set-up, checkpoints, held-out rules, Arrow passes and labelled samples."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.materialize import checkpoint_folder

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package and give checkpoints a place.

    ``spark.checkpoint.dir`` is read from the session and never replaced. Only where it is unset, and the session local
    as in tests, a folder of this process is used.
    """
    sc = spark.sparkContext
    known = sc.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)
    checkpoint_folder(spark)
    return spark


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; the path may be in any store that Spark reads."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def held_out(doc_id: str, modulus: int, rest: int) -> Column:
    """Whether a document is kept from learning; a null id counts as not held out (and is never learned from)."""
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(False))


#: What a Python worker keeps from one task to the next: one object, a table of words or of tokens.
_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """The worker's object of that name, made if it holds another or none."""
    if name not in _kept:
        forget()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Free what the worker keeps, as another operator's tasks need the memory."""
    if _kept:
        _kept.clear()
        gc.collect()


def with_arrow(df: DataFrame, fields: list[T.StructField], make: Callable[[], Callable[[pa.RecordBatch], list]], keep: list[str] | None = None, keeps: bool = False) -> DataFrame:
    """df, narrowed to the columns ``keep``, with columns computed batch by batch in Python.

    ``make()`` runs once in each task and gives a function from a batch to one array or list per field. An input
    column that has the name of a new one gives way to it. ``keeps``: whether the tasks use what the worker keeps;
    else it is freed.
    """
    new = {f.name for f in fields}
    held = [c for c in (df.columns if keep is None else keep) if c not in new]
    kept_types = {f.name: f for f in df.schema.fields}
    schema = T.StructType([kept_types[c] for c in held] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        compute = None
        for batch in batches:
            compute = compute or make()
            for part in pieces(batch):
                made = compute(part)
                columns = [part.column(part.schema.get_field_index(c)) for c in held]
                columns += [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=arrow.field(f.name).type) for f, x in zip(fields, made, strict=True)]
                columns = [c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes (one row at least), which bounds what Python holds of it."""
    n = batch.num_rows
    step = n if batch.nbytes <= most else max(1, int(n * most / batch.nbytes))
    for i in range(0, n, max(1, step)):
        yield batch.slice(i, step)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def clear_labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """One row per labelled document with a 0/1 label; rows that repeat must agree, or the document counts as unlabelled."""
    one = F.col(label).cast("int")
    return labels.where(F.col(doc_id).isNotNull() & one.isin(0, 1)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(one).alias("y"), F.max(one).alias("most")).where("y = most").select("doc_id", "y")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, modulus: int, rest: int, doc_id: str = "doc_id", present: bool = False) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` labelled documents of each class outside the held-out fold.

    The sample is the first ids by hash, so it is the same in each run. Only its ids (a bounded number) are broadcast;
    no text is shuffled. ``present``: labels that no row of docs has are left out before the sample is taken, so that
    docs may be fewer than the labelled ones without making it smaller.
    """
    learn = clear_labels(labels, doc_id, label).where(~held_out("doc_id", modulus, rest))
    if present:
        learn = learn.join(docs.where("text is not null").select(F.col(doc_id).alias("doc_id")), "doc_id", "left_semi")
    first = lambda y: learn.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    chosen = first(0).unionByName(first(1))
    return docs.select(F.col(doc_id).alias("doc_id"), "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
