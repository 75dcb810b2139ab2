"""What a run leaves: predictions, an evidence ledger, a receipt. Writers commit whole or not at all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab


def emitted(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows fit to be written: well-formed ids only, the first of each."""
    first = F.row_number().over(Window.partitionBy("case_id").orderBy(*order))
    return rows.where(F.col("case_id").rlike(vocab.CASE_ID)).withColumn("_n", first).where("_n = 1").drop("_n")


def write_predictions(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """The full set of predictions, replacing what was there."""
    emitted(rows, order or ["case_id"]).write.mode("overwrite").json(path)


def ledger_rows(predictions: DataFrame, evidence: DataFrame) -> DataFrame:
    """Predictions with a map from field to its evidence (value, source, rank, score, agreement); cases without any have
    none of that block."""
    e = F.struct("value", "source", "rank", "score", "agreement")
    maps = evidence.groupBy("case_id").agg(F.map_from_entries(F.collect_list(F.struct("field", e))).alias("evidence"))
    return predictions.join(maps, "case_id", "left")


def write_ledger(rows: DataFrame, path: str) -> None:
    """Nested rows as JSON; null blocks are left out."""
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def manifest(packets: DataFrame) -> DataFrame:
    """stem, length, sha256 of the inputs, for a receipt."""
    return packets.select("stem", "length", "sha256")


def write_receipt(before: DataFrame, after: DataFrame, path: str) -> None:
    """The inputs' manifest, written once and only if it is the same before and after the run."""
    changed = before.exceptAll(after).unionByName(after.exceptAll(before)).limit(1).count()
    if changed:
        raise ValueError("inputs changed during the run")
    before.write.mode("errorifexists").json(path)


def dump_pages(lines: DataFrame, path: str | None) -> None:
    """The lines of every page as they were read, one JSON row a page in their order; nothing is written without a path."""
    if path is None:
        return
    row = F.struct("line_no", "text", "conf")
    pages = lines.groupBy("case_id", "page").agg(F.array_sort(F.collect_list(row)).alias("lines"))
    pages.write.mode("overwrite").json(path)


def append_timings(rows: DataFrame, path: str) -> None:
    """Timings (case_id, stage, seconds) added to those that are there; rows without a finite, non-negative time are left out."""
    good = F.col("seconds").isNotNull() & ~F.isnan("seconds") & (F.col("seconds") >= 0) & (F.col("seconds") < float("inf"))
    rows.where(good).select("case_id", "stage", "seconds").write.mode("append").json(path)


def write_run_receipt(before: DataFrame, read_again: Callable[[], DataFrame], body: dict[str, str], path: str) -> None:
    """One row: the body of a run, the number of its inputs and a digest of their manifest. The inputs are hashed again
    first; if any differs, or a receipt is there already, nothing is written."""
    after = read_again()
    if before.exceptAll(after).unionByName(after.exceptAll(before)).limit(1).count():
        raise ValueError("inputs changed during the run")
    line = F.sha2(F.concat_ws("|", "stem", F.col("length").cast("string"), "sha256"), 256)
    lanes = [F.sum(F.conv(F.substring(line, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(5)]  # sums don't depend on order
    row = before.agg(F.count(F.lit(1)).alias("inputs"), F.sha2(F.concat_ws("|", *[F.coalesce(x, F.lit("0")) for x in lanes]), 256).alias("manifest"))
    row.select(*[F.lit(v).alias(k) for k, v in sorted(body.items())], "inputs", "manifest").write.mode("errorifexists").json(path)
