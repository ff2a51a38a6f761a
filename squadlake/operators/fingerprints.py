"""Fingerprints of partitions: equal rows give equal ones, in whatever order and files they lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# A prime below the largest long: sums of row hashes are kept modulo this.
MODULUS = 9223372036854775783


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row's values by column name.

    The hash function passes over NULL, so that every column brings a mark for it; nested values are hashed as
    JSON, in which NULL elements are written out.
    """
    inputs: list[Column] = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        column = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, ArrayType | MapType | StructType)
        inputs += [F.lit(field.name), column.isNull(), F.to_json(column) if nested else column]
    return F.xxhash64(*inputs)


def fingerprints(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``rows, fingerprint`` of each partition: the number of rows and the sum of their hashes.

    Repeated rows count each time. Sums are exact and add up on the map side, so a hot partition is no
    hot task.
    """
    hashed = df.select(*keys, row_hash(df).cast("decimal(38, 0)").alias("__hash"))
    total = F.coalesce(F.sum("__hash"), F.lit(0).cast("decimal(38, 0)"))
    fingerprint = F.pmod(total, F.lit(MODULUS).cast("decimal(38, 0)")).cast("bigint")
    return hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), fingerprint.alias("fingerprint")
    )
