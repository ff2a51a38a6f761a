"""Which staged files a lake was built from, and which seasons changed since."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.functions.paths import decode_path, season_from_path

FILES = "path string, length bigint, modified timestamp, season int"


def list_files(spark: SparkSession, staging: str, glob: str = "*.json") -> DataFrame:
    """``path, length, modified, season`` of the files below ``staging``; none of them is opened."""
    listed = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=glob)
        .load(staging)
        .select(decode_path("path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    )
    return listed.withColumn("season", season_from_path("path"))


def changed_files(now: DataFrame, before: DataFrame) -> DataFrame:
    """``path, season, change`` of files that are ``new``, ``changed`` or ``deleted`` between two listings.

    A file whose length and time of modification are the same counts as unchanged. One join on the path: the
    listings are as long as there are files, whatever these hold.
    """
    left, right = now.alias("now"), before.alias("before")
    joined = left.join(right, F.col("now.path") == F.col("before.path"), "full_outer")
    change = (
        F.when(F.col("before.path").isNull(), "new")
        .when(F.col("now.path").isNull(), "deleted")
        .when(
            (F.col("now.length") != F.col("before.length"))
            | (F.col("now.modified") != F.col("before.modified")),
            "changed",
        )
    )
    return joined.select(
        F.coalesce("now.path", "before.path").alias("path"),
        F.coalesce("now.season", "before.season").alias("season"),
        change.alias("change"),
    ).where(F.col("change").isNotNull())
