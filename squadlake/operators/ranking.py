"""Top-k reports."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Above this rank Spark plans no per-task limit ahead of the shuffle.
GROUP_LIMIT_CONF = "spark.sql.window.group.limit.threshold"


def _best_first(value: str, tie_break: Sequence[str]):
    if not tie_break:
        raise ValueError("tie_break needs columns that make the order total")
    return [F.col(value).desc_nulls_last(), *[F.col(name).asc() for name in tie_break]]


def rank_at_most(df: DataFrame, k: int, rank: str = "rank") -> DataFrame:
    return df.where(F.col(rank) <= k)


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    k: int,
    tie_break: Sequence[str],
    rank: str = "rank",
    salts: int | None = None,
) -> DataFrame:
    """The ``k`` rows with the highest value in every group, ranked from 1.

    Rounds rank within (group, salt) and keep ``k`` rows of each, with ever fewer salts, until
    a last round ranks the group. Where Spark itself keeps at most ``k`` rows of a group
    in each task before the shuffle, one round is enough. It plans no such limit for large
    ``k``; then the first round deals a group to as many salts as a shuffle has
    partitions and the second to the square root of that, so that no task sorts more than
    its share of a group or ``k`` rows for each salt it gathers. ``salts`` gives the
    first round's number.
    """
    order = _best_first(value, tie_break)
    if salts is None:
        conf = df.sparkSession.conf
        limited = k < int(conf.get(GROUP_LIMIT_CONF, "1000"))
        salts = 1 if limited else int(conf.get("spark.sql.shuffle.partitions"))
    for number in [n for n in (salts, isqrt(salts)) if n > 1] + [1]:
        salt = F.pmod(F.xxhash64(*tie_break), F.lit(number))
        within = Window.partitionBy(*keys, *([salt] if number > 1 else [])).orderBy(*order)
        df = rank_at_most(df.drop(rank).withColumn(rank, F.row_number().over(within)), k, rank)
    return df


def max_per_entity(
    df: DataFrame, entity: Sequence[str], value: str, alias: str = "max_value"
) -> DataFrame:
    return df.groupBy(*entity).agg(F.max(value).alias(alias))


# Buckets of entities for each rank asked for: the more, the fewer entities share one.
BUCKETS_PER_RANK = 64


def top_entities(
    df: DataFrame,
    entity: Sequence[str],
    value: str,
    k: int,
    alias: str = "max_value",
    rank: str = "rank",
) -> DataFrame:
    """The ``k`` entities with the highest maximum, ranked from 1; ties go to the smaller entity.

    Same rows as ``max_per_entity`` and ``top_n_overall``, without a shuffle of every entity. Entities are
    dealt to a fixed number of buckets by their hash. The best values of two buckets belong to different entities, so
    the k-th best bucket is a lower bound for the k-th entity. Rows below it are left out where they are read; what is
    left for the shuffle is little more than ``k`` entities a task, and all that tie with the bound. The bound costs a
    second scan of two columns and one row for each bucket and task. With fewer than ``k`` buckets in use nothing is left out.
    """
    reaching = rows_that_reach(df, entity, value, k)
    return top_n_overall(max_per_entity(reaching, entity, value, alias), alias, k, entity, rank)


def rows_that_reach(df: DataFrame, entity: Sequence[str], value: str, k: int) -> DataFrame:
    """Rows whose value is not below the bound of ``top_entities``."""
    bucket = F.pmod(F.xxhash64(*entity), F.lit(k * BUCKETS_PER_RANK))
    best = df.groupBy(bucket.alias("bucket")).agg(F.max(value).alias("best"))
    bound = (
        best.orderBy(F.desc_nulls_last("best"))
        .limit(k)
        .agg(F.when(F.count("best") == k, F.min("best")).alias("bound"))
        .scalar()
    )
    return df.where(bound.isNull() | (F.col(value) >= bound))


def top_n_overall(
    df: DataFrame, value: str, k: int, tie_break: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The ``k`` rows with the highest value of the whole table, ranked from 1.

    The limit comes first, as one top-k per task and a merge of those; the
    ranking window then sees ``k`` rows however large the table is.
    """
    order = _best_first(value, tie_break)
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))
