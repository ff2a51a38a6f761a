"""Ranking, profile and growth operators on FACT, lineitem and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, sql_round, table
from checks.views import FACT_SQL, cents, fact
from squadlake import functions
from squadlake import operators as ops

SIZE_BANDS = (("1-9", None, 9), ("10-19", 10, 19), ("20-34", 20, 34))


@check(
    FACT_SQL
    + """
select entity_id, entity, team, season, value, rank from (
    select *, cast(row_number() over (
        partition by season order by value desc, o_orderkey) as integer) as rank
    from fact where season >= 1996)
where rank <= 10
"""
)
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact(spark, sf_dir, first_season=1996)
    ranked = ops.top_n_per_group(rows, ["season"], "value", 10, ["o_orderkey"])
    return ranked.select("entity_id", "entity", "team", "season", "value", "rank")


@check(
    FACT_SQL
    + """
select o_orderkey, season, value, rank from (
    select *, cast(row_number() over (
        partition by season order by value desc, o_orderkey) as integer) as rank
    from fact)
where rank <= 1500
"""
)
def top_n_per_group_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ops.top_n_per_group(fact(spark, sf_dir), ["season"], "value", 1500, ["o_orderkey"])
    return ranked.select("o_orderkey", "season", "value", "rank")


@check(
    FACT_SQL
    + """
, best as (select entity_id, entity, max(value) as max_value from fact group by all)
select entity_id, entity, max_value, rank from (
    select *, cast(row_number() over (order by max_value desc, entity_id) as integer) as rank
    from best)
where rank <= 15
"""
)
def top_n_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = ops.max_per_entity(fact(spark, sf_dir), ["entity_id", "entity"], "value")
    return ops.top_n_overall(best, "max_value", 15, ["entity_id"])


@check(
    """
select l_partkey, max_value, rank from (
    select *, cast(row_number() over (order by max_value desc, l_partkey) as integer) as rank
    from (select l_partkey, max(l_quantity) as max_value from lineitem group by l_partkey))
where rank <= 40
"""
)
def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by their largest order; quantities are few, so most parts tie."""
    return ops.top_entities(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_quantity", 40)


@check(FACT_SQL + "select entity, max(value) as max_value from fact group by entity")
def max_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.max_per_entity(fact(spark, sf_dir), ["entity"], "value")


@check(
    f"""
select cast(year(l_shipdate) as integer) as season,
       round(corr(l_quantity, l_extendedprice), 6) as price_correlation,
       {sql_round("avg(" + cents("l_extendedprice") + ")")} as avg_price
from lineitem group by 1
"""
)
def corr_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"),
        "l_quantity",
        F.expr(cents("l_extendedprice")).alias("price"),
    )
    return ops.corr_by_group(
        lines, ["season"], "l_quantity", "price", "price_correlation", "avg_price"
    ).withColumns(
        {
            "price_correlation": F.round("price_correlation", 6),
            "avg_price": F.round("avg_price", 2),
        }
    )


@check(
    f"""
select cast(year(o_orderdate) as integer) as season, round(corr(o_custkey, {cents("o_totalprice")}), 6) as price_correlation,
       {sql_round("avg(" + cents("o_totalprice") + ")")} as avg_price
from orders group by 1
"""
)
def corr_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-totals by month and status, merged by year."""
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("month"),
        "o_orderstatus",
        "o_custkey",
        F.expr(cents("o_totalprice")).alias("price"),
    )
    moments = ops.moments_by_group(orders, ["season", "month", "o_orderstatus"], "o_custkey", "price")
    merged = ops.corr_from_moments(
        moments, ["season"], corr_alias="price_correlation", mean_alias="avg_price"
    )
    return merged.withColumns(
        {"price_correlation": F.round("price_correlation", 6), "avg_price": F.round("avg_price", 2)}
    )


@check(
    FACT_SQL
    + f"""
select season, position, {sql_round("avg(cents)")} as avg_value, count(*) as player_count
from fact group by season, position
"""
)
def profile_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = ops.profile_by_category(fact(spark, sf_dir), ["season", "position"], "cents")
    return profile.withColumn("avg_value", F.round("avg_value", 2))


@check(
    f"""
select p_brand, size_group, {sql_round("avg(" + cents("p_retailprice") + ")")} as avg_value,
       count(*) as player_count, cast(case size_group when '1-9' then 1 when '10-19' then 2
       when '20-34' then 3 else 4 end as integer) as band_order
from (select *, case when p_size <= 9 then '1-9' when p_size between 10 and 19 then '10-19'
                     when p_size between 20 and 34 then '20-34' else 'Over 34' end as size_group
      from part)
group by p_brand, size_group
"""
)
def profile_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.profile_by_band(
        table(spark, sf_dir, "part").withColumn("price", F.expr(cents("p_retailprice"))),
        ["p_brand"],
        "p_size",
        "price",
        SIZE_BANDS,
        "Over 34",
        band_alias="size_group",
        order_alias="band_order",
    ).withColumn("avg_value", F.round("avg_value", 2))


@check(
    FACT_SQL
    + f"""
select *, {sql_round("injured_players / total_players * 100")} as injury_rate from (
    select season, team, count(*) as total_players,
           cast(sum(case when status = 'F' then 1 else 0 end) as bigint) as injured_players
    from fact group by season, team)
"""
)
def conditional_rate_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.conditional_rate(fact(spark, sf_dir), ["season", "team"], F.col("status") == "F")


@check(
    f"""
select *, {sql_round("returned / total * 100")} as return_rate from (
    select cast(year(l_shipdate) as integer) as season, l_linestatus, count(*) as total,
           cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as returned
    from lineitem group by 1, 2)
"""
)
def conditional_rate_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("season", F.year("l_shipdate"))
    return ops.conditional_rate(
        lines,
        ["season", "l_linestatus"],
        F.col("l_returnflag") == "R",
        total_alias="total",
        hits_alias="returned",
        rate_alias="return_rate",
    )


@check(
    FACT_SQL
    + f"""
select team, season, {sql_round("avg(balance)")} as avg_squad_age from fact group by team, season
"""
)
def avg_by_team_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.avg_by_group(fact(spark, sf_dir), ["team", "season"], "balance", "avg_squad_age")


@check(
    FACT_SQL
    + f"select season, {sql_round('avg(balance)')} as avg_season_age from fact group by season"
)
def avg_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.avg_by_group(fact(spark, sf_dir), ["season"], "balance", "avg_season_age")


@check(
    f"""
select p_brand, {sql_round("avg(p_size)")} as overall_avg_age,
       min(p_size) as min_age, max(p_size) as max_age
from part group by p_brand
"""
)
def stats_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stats_by_group(table(spark, sf_dir, "part"), ["p_brand"], "p_size")


TOTALS_SQL = (
    FACT_SQL
    + """
, totals as (
    select season, team, cast(sum(cents) as bigint) as total_value, count(*) as squad_size
    from fact group by season, team)
"""
)


@check(TOTALS_SQL + "select * from totals")
def total_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.total_by_group(fact(spark, sf_dir), ["season", "team"], "cents")


@check(
    TOTALS_SQL
    + f"""
select season, team, total_value, squad_size, previous_value,
       cast(season - previous_season as integer) as season_gap,
       round((total_value - previous_value) / previous_value * 100, 6) as yoy_growth,
       {sql_round("total_value / squad_size")} as avg_player_value
from (select *, lag(total_value) over (partition by team order by season) as previous_value,
             lag(season) over (partition by team order by season) as previous_season
      from totals)
"""
)
def yoy_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = ops.total_by_group(fact(spark, sf_dir), ["season", "team"], "cents")
    growth = ops.yoy_growth(totals, "team", "season")
    return growth.withColumn("yoy_growth", F.round("yoy_growth", 6))


@check(
    TOTALS_SQL
    + """
select *, round((final_value - initial_value) / initial_value * 100, 6) as total_growth_percent
from (select team, min(season) as start_season, max(season) as end_season,
             min_by(total_value, season) as initial_value,
             max_by(total_value, season) as final_value
      from totals group by team)
"""
)
def first_last_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = ops.total_by_group(fact(spark, sf_dir), ["season", "team"], "cents")
    growth = ops.first_last_by_order(totals, "team", "season")
    return growth.withColumn("total_growth_percent", F.round("total_growth_percent", 6))


@check(
    """
select p_partkey, round((p_retailprice - base) / nullif(base, 0) * 100, 6) as growth
from (select *, p_size - 10 as base from part)
"""
)
def growth_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    growth = functions.growth_percent("p_retailprice", F.col("p_size") - 10)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(growth, 6).alias("growth"))
