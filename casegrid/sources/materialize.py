"""Cutting lineage where a result is used more than once, and the folder that this needs."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package."""
    sc = spark.sparkContext
    known = sc.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors must share: the one that is set, or ``spark.checkpoint.dir``.

    Only a local session, whose executors are this process, gets a folder of its own where neither is set; on a cluster
    that is an error, as the driver's folders can't be seen elsewhere.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="casegrid-checkpoints-"))
    return sc.getCheckpointDir()


def materialized(df: DataFrame) -> DataFrame:
    """df, computed once and written to the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
