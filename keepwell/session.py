"""Session-level settings read from, never imposed on, the running cluster."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def checkpoint_ready(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable.

    The shared folder named by ``spark.checkpoint.dir`` wins. Only a local
    master falls back to a scratch folder; on a cluster a machine-local folder
    would be lost with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="keepwell-checkpoint-")
    sc.setCheckpointDir(folder)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    checkpoint_ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_keepwell_shipped", False):
        return
    root = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="keepwell-package-")) / "keepwell"
    sc.addPyFile(shutil.make_archive(str(base), "zip", root.parent, root.name))
    sc._keepwell_shipped = True


ROWS_PER_TASK = 250_000
MOST_ROWS_PER_TASK = 1_000_000


def for_iteration(df: DataFrame, rows: int | None = None, work: int = 1) -> DataFrame:
    """Input of an iterative fit: partitions sized to the rows, kept in memory.

    A fit runs one job per iteration, so many near-empty tasks cost more than
    the arithmetic. ``work`` is what a row costs in units of a small fit: dear rows
    are spread over the cores as well. Every task of every iteration answers to the
    driver: more partitions than cores are made only beyond MOST_ROWS_PER_TASK.
    Partitions that do not fit in memory spill to disk.
    """
    rows = df.count() if rows is None else rows
    least, wanted = -(-rows // MOST_ROWS_PER_TASK), -(-rows * max(work, 1) // ROWS_PER_TASK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, least, min(cores, wanted))).persist()
