"""Grouped profiles.

All of these are plain aggregates, which Spark reduces on the map side: a hot
group costs one partial row per task, not a hot task.

``rows``: by default every input row counts once. On input that is already
aggregated, ``rows`` names the column with the number of rows behind each input
row, and value columns hold sub-totals over those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadlake import fixed_values as fixed
from squadlake.functions.bands import Band, band, band_order
from squadlake.functions.numeric import co_moments, corr_of_moments, pearson, ratio_percent


def _count(rows: str | None) -> Column:
    return F.count(F.lit(1)) if rows is None else F.sum(rows)


def _mean(value: str, rows: str | None) -> Column:
    return F.avg(value) if rows is None else F.try_divide(F.sum(value), F.sum(rows))


def corr_by_group(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    y: str,
    corr_alias: str = "age_value_correlation",
    mean_alias: str = "avg_market_value",
) -> DataFrame:
    """Correlation of ``x`` and ``y`` and the mean of ``y``."""
    return df.groupBy(*keys).agg(pearson(x, y).alias(corr_alias), F.avg(y).alias(mean_alias))


def moments_by_group(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Sub-totals for ``corr_from_moments``: exact, and mergeable over any grouping of the keys."""
    moments = [column.alias(name) for name, column in co_moments(x, y).items()]
    return df.groupBy(*keys).agg(
        F.count(y).alias("value_rows"), F.try_sum(F.col(y).cast("decimal(38, 0)")).alias("value_total"), *moments
    )


MOMENTS = ("pairs", "sum_x", "sum_y", "sum_xx", "sum_xy", "sum_yy")


def corr_from_moments(
    moments: DataFrame,
    keys: Sequence[str],
    value: str = "value_total",
    rows: str = "value_rows",
    corr_alias: str = "age_value_correlation",
    mean_alias: str = "avg_market_value",
) -> DataFrame:
    """``corr_by_group`` from sub-totals: the columns of ``co_moments``, and total and number of the second value."""
    merged = moments.groupBy(*keys).agg(
        *[F.try_sum(name).alias(name) for name in MOMENTS],
        F.try_divide(F.sum(value).cast("double"), F.sum(rows)).alias(mean_alias),
    )
    return merged.select(
        *keys, corr_of_moments({name: F.col(name) for name in MOMENTS}).alias(corr_alias), mean_alias
    )


def profile_by_category(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    mean_alias: str = "avg_value",
    count_alias: str = "player_count",
    rows: str | None = None,
) -> DataFrame:
    return df.groupBy(*keys).agg(_mean(value, rows).alias(mean_alias), _count(rows).alias(count_alias))


def profile_by_band(
    df: DataFrame,
    keys: Sequence[str],
    banded: str,
    value: str,
    bands: Sequence[Band] = fixed.AGE_BANDS,
    otherwise: str = fixed.OLDEST_BAND,
    null_label: str | None = None,
    band_alias: str = "age_group",
    order_alias: str | None = None,
    **profile,
) -> DataFrame:
    """Profile by inclusive bands; ``order_alias`` adds the position of the band."""
    labelled = df.withColumn(band_alias, band(banded, bands, otherwise, null_label))
    result = profile_by_category(labelled, [*keys, band_alias], value, **profile)
    if order_alias is not None:
        result = result.withColumn(order_alias, band_order(band_alias, bands))
    return result


def conditional_rate(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    hits: str | None = None,
    total_alias: str = "total_players",
    hits_alias: str = "injured_players",
    rate_alias: str = "injury_rate",
    rows: str | None = None,
) -> DataFrame:
    """Rows, rows that meet a condition, and their share in percent.

    Pass ``condition`` for rows, or ``hits`` with ``rows`` for sub-totals.
    """
    if (condition is None) == (hits is None):
        raise ValueError("pass either condition or hits")
    hit_count = F.count_if(condition) if hits is None else F.sum(hits)
    counted = df.groupBy(*keys).agg(_count(rows).alias(total_alias), hit_count.alias(hits_alias))
    return counted.withColumn(rate_alias, ratio_percent(hits_alias, total_alias))


def avg_by_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    alias: str,
    places: int = 2,
    rows: str | None = None,
) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(_mean(value, rows), places).alias(alias))


def stats_by_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    mean_alias: str = "overall_avg_age",
    min_alias: str = "min_age",
    max_alias: str = "max_age",
    places: int = 2,
    rows: str | None = None,
    lowest: str | None = None,
    highest: str | None = None,
) -> DataFrame:
    """Mean, minimum and maximum; sub-totals bring their own ``lowest`` and ``highest``."""
    return df.groupBy(*keys).agg(
        F.round(_mean(value, rows), places).alias(mean_alias),
        F.round(F.min(lowest or value), places).alias(min_alias),
        F.round(F.max(highest or value), places).alias(max_alias),
    )


def total_by_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    total_alias: str = "total_value",
    count_alias: str = "squad_size",
    rows: str | None = None,
) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(total_alias), _count(rows).alias(count_alias))
