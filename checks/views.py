"""FACT: orders as player-seasons. Team is the nation, position the market segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table


def cents(column: str) -> str:
    """Money in whole cents: sums are exact, whatever the order of addition."""
    return f"cast(round({column} * 100) as bigint)"



def fact(spark: SparkSession, sf_dir: str, first_season: int | None = None) -> DataFrame:
    """Join strategies are left to the planner, which knows the sizes.

    A season floor is stated on the order date, so that it reaches the scan.
    """
    orders = table(spark, sf_dir, "orders")
    if first_season is not None:
        orders = orders.where(F.col("o_orderdate") >= F.make_timestamp_ntz(
            F.lit(first_season), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
        ))
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            F.year("o_orderdate").alias("season"),
            F.col("n_name").alias("team"),
            F.col("c_custkey").alias("entity_id"),
            F.col("c_name").alias("entity"),
            F.col("c_mktsegment").alias("position"),
            F.col("o_totalprice").alias("value"),
            F.expr(cents("o_totalprice")).alias("cents"),
            F.col("o_orderstatus").alias("status"),
            F.expr(cents("c_acctbal")).alias("balance"),
        )
    )


FACT_SQL = f"""
with fact as (
    select o_orderkey, cast(year(o_orderdate) as integer) as season, n_name as team,
           c_custkey as entity_id, c_name as entity, c_mktsegment as position,
           o_totalprice as value, {cents("o_totalprice")} as cents, o_orderstatus as status,
           {cents("c_acctbal")} as balance
    from orders
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
)
"""
