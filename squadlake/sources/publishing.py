"""Copies of a layer in another store: only partitions that differ are moved, and what arrives is verified."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.operators.fingerprints import fingerprints
from squadlake.sources.layers import CLUSTER_BY, PARTITION_BY, _overlap
from squadlake.sources.snapshots import Change, read_table

#: What a layer's published tables consist of, kept next to them.
PUBLISHED = "fingerprints"
FINGERPRINTS = "table string, partition string, rows bigint, fingerprint bigint, copied boolean"


class CopyDiffers(RuntimeError):
    """What arrived isn't what was sent; nothing was committed."""


class Table(NamedTuple):
    name: str
    schema: str | None = None
    partition_by: Sequence[str] = PARTITION_BY
    cluster_by: Sequence[str] = CLUSTER_BY


Marks = dict[str | None, tuple[int, int]]


def _marks(rows: DataFrame, by: Sequence[str]) -> Marks:
    """(rows, fingerprint) by partition; a table without partitions is one. As many rows as there are seasons."""
    key = F.col(by[0]).cast("string") if by else F.lit(None).cast("string")
    found = fingerprints(rows, by[:1]).select(key.alias("partition"), "rows", "fingerprint").collect()
    return {row["partition"]: (row["rows"], row["fingerprint"]) for row in found if row["rows"]}


def _in(rows: DataFrame, by: Sequence[str], partitions: Sequence[str | None]) -> DataFrame:
    wanted = F.lit(False)
    for partition in partitions:
        wanted = wanted | F.col(by[0]).eqNullSafe(F.lit(partition).cast(rows.schema[by[0]].dataType))
    return rows.where(wanted)


def _publish(rows: DataFrame, change: Change, table: Table, had: Marks) -> tuple[Marks, set[str | None]]:
    """Copy what differs from ``had``; gives the marks of the source and the partitions copied."""
    by = table.partition_by
    marks = _marks(rows, by)
    known = change.base is not None and table.name in change.base.tables
    differing = {p for p in {*marks, *had} if marks.get(p) != had.get(p)} if known else set(marks)
    if known and not differing:
        return marks, differing
    partial = bool(by) and known
    change.write(
        _in(rows, by, sorted(differing, key=str)) if partial else rows,
        table.name,
        by,
        table.cluster_by,
        rebalance=False,
        touched=sorted(differing, key=str) if partial else None,
    )
    arrived = change.read(table.name, table.schema)
    if partial:
        arrived = _in(arrived, by, sorted(differing, key=str))
    expected = {p: marks[p] for p in differing if p in marks}
    if _marks(arrived, by) != expected:
        raise CopyDiffers(f"{change.layer}/{table.name} was written, but is not what was read")
    return marks, differing


def publish_tables(
    spark: SparkSession, source: str, destination: str, tables: Sequence[Table], verify: bool = False
) -> DataFrame:
    """Make the tables of ``destination`` those of ``source``, two layers of any stores Spark can reach, in one commit.

    Gives ``table, partition, rows, fingerprint, copied``. The source is read once for its fingerprints; partitions whose
    fingerprint is the one published last are left as they are, the others are copied and read back. A copy
    that differs ends the run, and readers keep the version before. With ``verify`` the destination's own rows
    are read for their fingerprints too, so that damage there is found and mended.
    """
    for table in tables:
        if _overlap(spark, f"{source}/{table.name}", f"{destination}/{table.name}"):
            raise ValueError(f"refusing to publish {source}/{table.name} over itself")
    change = Change(spark, destination)
    stored: dict[str, Marks] = {}
    if change.base is not None and PUBLISHED in change.base.tables:
        for row in change.read(PUBLISHED, FINGERPRINTS).collect():
            stored.setdefault(row["table"], {})[row["partition"]] = (row["rows"], row["fingerprint"])
    report = []
    for table in tables:
        rows = read_table(spark, source, table.name, table.schema)
        had = stored.pop(table.name, {})
        if verify and change.base is not None and table.name in change.base.tables:
            had = _marks(change.read(table.name, table.schema), table.partition_by)
        marks, copied = _publish(rows, change, table, had)
        report += [(table.name, partition, *mark, partition in copied) for partition, mark in marks.items()]
    if change.base is not None and change.tables == change.base.tables:
        return change.read(PUBLISHED, FINGERPRINTS).withColumn("copied", F.lit(False))
    # Tables published before and not asked for now keep their marks.
    report += [(name, partition, *mark, False) for name, marks in stored.items() for partition, mark in marks.items()]
    change.write(spark.createDataFrame(report, FINGERPRINTS), PUBLISHED, (), ("table",), rebalance=False)
    change.commit()
    return read_table(spark, destination, PUBLISHED, FINGERPRINTS)


def publish_layer(
    spark: SparkSession,
    source: str,
    destination: str,
    schema: str | None = None,
    partition_by: Sequence[str] = PARTITION_BY,
    cluster_by: Sequence[str] = CLUSTER_BY,
) -> DataFrame:
    """``publish_tables`` for one table, both places given as ``<layer>/<table>``; names may differ only in the layer."""
    (source, name), (destination, copy) = (p.rstrip("/").rsplit("/", 1) for p in (source, destination))
    if name != copy:
        raise ValueError(f"a published table keeps its name: {name}, not {copy}")
    return publish_tables(spark, source, destination, [Table(name, schema, partition_by, cluster_by)])
