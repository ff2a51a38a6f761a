"""Helpers the operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(frame: DataFrame) -> DataFrame:
    """The rows, written to the folder all executors share, so that no later step repeats the work.

    The folder is the session's own; only where it names none one is set, as in tests.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


#: Rows that Python workers get at once: texts can be long, and a batch is held off the heap.
BATCH_ROWS = 1_000


def findable(frame: DataFrame) -> DataFrame:
    """``frame``, with this package's folder on the path of Python workers, and batches of BATCH_ROWS.

    On a cluster the package is installed or sent along; on one machine workers look for it where the
    driver found it, whatever folder it was started in.
    """
    conf = frame.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    environment = frame.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return frame


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    Texts without other than ASCII characters take Spark's faster byte-wise path.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


#: Rows of a few numbers each that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def small_side(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` to be broadcast if it has at most ``rows`` rows, else as it is, for a shuffle join."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def is_held_out() -> Column:
    """A third of the ids, kept from training: crc32 of the id as text leaves 1 on division by 3."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1
