"""Growth from period to period and from first to last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squadlake.functions.numeric import growth_percent


def yoy_growth(
    totals: DataFrame,
    entity: str,
    period: str,
    total: str = "total_value",
    size: str = "squad_size",
) -> DataFrame:
    """Growth over the previous period that the entity has.

    ``totals`` has one row per (entity, period), so a window partition is as long
    as the calendar, whatever the size of the table behind it. After a gap the
    previous period is more than one step away; ``<period>_gap`` says how far.
    """
    timeline = Window.partitionBy(entity).orderBy(period)
    return totals.withColumns(
        {
            "previous_value": F.lag(total).over(timeline),
            f"{period}_gap": F.col(period) - F.lag(period).over(timeline),
        }
    ).withColumns(
        {
            "yoy_growth": growth_percent(total, "previous_value"),
            "avg_player_value": F.round(F.try_divide(total, size), 2),
        }
    )


def first_last_by_order(
    totals: DataFrame, entity: str, period: str, total: str = "total_value"
) -> DataFrame:
    """First and last period of every entity, the totals there, and the growth between.

    ``min_by`` / ``max_by`` carry the order inside the aggregate, so the answer
    does not depend on how rows arrive after a shuffle.
    """
    return (
        totals.groupBy(entity)
        .agg(
            F.min(period).alias(f"start_{period}"),
            F.max(period).alias(f"end_{period}"),
            F.min_by(total, period).alias("initial_value"),
            F.max_by(total, period).alias("final_value"),
        )
        .withColumn("total_growth_percent", growth_percent("final_value", "initial_value"))
    )
