"""Session settings the library is tuned for."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles, splits skewed joins and rebalanced writes by
# the bytes it sees, so no query sets a partition count of its own.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("squadlake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors can reach, for tables that one query writes and reads.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    """Made once for a local application, and removed with all it holds when Python ends."""
    folder = tempfile.mkdtemp(prefix=f"squadlake-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
