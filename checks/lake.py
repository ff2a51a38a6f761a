"""A whole lake built from orders: bronze, silver and the twelve gold tables.

Every order is a player-season. Its raw texts are good or bad by key, so all the
cleaning rules and reject reasons occur; the SQL states the clean values directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, sql_round, table
from checks.rules import amount_sql, amount_text, by_remainder, club_name, club_sql
from checks.tables import scratch
from squadlake import sources
from squadlake.functions import file_name_of, season_from_path, team_from_file_name
from squadlake.plans import (
    Lake,
    bronze_coverage,
    file_squads,
    lake_quality,
    presentation,
    run_gold,
    run_silver,
)
from squadlake.sources.schemas import PLAYER_FIELDS

# Orders per squad document: order keys are unique, so no document grows beyond this.
KEYS_PER_DOCUMENT = 1000


def squads(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    date = F.col("o_orderdate")
    season = 2000 + 2 * (F.year(date) - 1995) + F.when(F.month(date) > 6, 1).otherwise(0)
    text = {
        "id": F.col("o_custkey").cast("string"),
        "name": F.col("c_name"),
        "position": F.col("c_mktsegment"),
        "age": F.when(key % 37 == 0, "n/a").when(key % 41 != 0, (16 + key % 22).cast("string")),
        "nationality": by_remainder(
            "o_orderkey",
            [F.array("c_mktsegment", "o_orderpriority"), F.array("c_mktsegment"), None],
        ),
        "height": F.when(key % 31 == 0, "").otherwise(
            F.concat(F.lit("1,"), (50 + key % 50).cast("string"), F.lit("m"))
        ),
        "foot": by_remainder("o_orderkey", ["right", "LEFT", "", None, "both", "left", "Right"]),
        "signedFrom": by_remainder(
            "o_orderkey", [F.concat(F.col("c_name"), F.lit(": fee")), "", None, ":x", " Club "]
        ),
        "marketValue": amount_text("o_orderkey", "o_totalprice"),
        "status": by_remainder("o_orderkey", [None, "Team captain", "Knee injury", ""]),
    }
    player = F.struct(
        *[text.get(name, F.lit(None).cast("string")).alias(name) for name in PLAYER_FIELDS]
    )
    path = F.concat_ws(
        "/",
        F.lit("staging"),
        F.concat(F.lit("Season_"), F.col("season")),
        F.concat(F.concat_ws("_", "club", "document", "season"), F.lit(".json")),
    )
    club = club_name(F.replace("n_name", F.lit("_"), F.lit("")), "n_nationkey").alias("club")
    clubs = table(spark, sf_dir, "nation").select("n_nationkey", club)
    squad = ("document", "season", "club")
    documents = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(clubs, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            *("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"),
            *("c_name", "c_mktsegment", "club"),
            season.cast("int").alias("season"),
            F.floor(key / KEYS_PER_DOCUMENT).alias("document"),
        )
        # Narrow rows are dealt out, and players are made where their squad is collected.
        .repartition(*squad)
        .select(player.alias("player"), *squad)
        .groupBy(*squad)
        .agg(F.collect_list("player").alias("players"))
        .select(F.col("document").cast("string").alias("id"), "players", path.alias("source_file"))
    )
    return documents.withColumns(
        {
            "updatedAt": F.lit("2024-01-01"),
            "_corrupt_record": F.lit(None).cast("string"),
            "team": team_from_file_name(file_name_of("source_file")),
            "season": season_from_path("source_file"),
        }
    )


_BUILT: dict[tuple[str, str], Lake] = {}


def built_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake over these tables, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        lake = Lake(scratch(spark, "lake"))
        file_squads(squads(spark, sf_dir), lake)
        run_silver(spark, lake)
        run_gold(spark, lake)
        _BUILT[key] = lake
    return _BUILT[key]


# A team name ends before the first "_<digit>", so NATION_7 becomes NATION7.
CLUB_SQL = club_sql("replace(n_name, '_', '')", "n_nationkey")

LAKE_SQL = f"""
with flat as (
    select cast(o_custkey as varchar) as players_id, c_name as players_name,
           c_mktsegment as players_position,
           cast(case when o_orderkey % 37 <> 0 and o_orderkey % 41 <> 0
                     then 16 + o_orderkey % 22 end as integer) as players_age,
           cast(case when o_orderkey % 31 <> 0 then 150 + o_orderkey % 50 end as integer)
               as players_height,
           case o_orderkey % 7 when 0 then 'Right' when 1 then 'Left' when 4 then 'Both'
               when 5 then 'Left' when 6 then 'Right' end as players_foot,
           case o_orderkey % 5 when 0 then c_name when 4 then 'Club' else 'No team' end
               as "players_signedFrom",
           cast({amount_sql("o_orderkey", "o_totalprice")} as bigint) as "players_marketValue",
           case when o_orderkey % 4 = 2 then 'Injuried' else 'Available to play' end
               as players_status,
           case when o_orderkey % 3 = 2 then 'None' else c_mktsegment end
               as player_first_nationality,
           case when o_orderkey % 3 = 0 then o_orderpriority else 'None' end
               as player_second_nationality,
           array_to_string(list_filter(string_split({CLUB_SQL}, '_'),
                           lambda word: word <> 'FC' and word <> ''), ' ') as team,
           cast(2000 + 2 * (year(o_orderdate) - 1995)
                + case when month(o_orderdate) > 6 then 1 else 0 end as integer) as season,
           {CLUB_SQL} as club, o_orderkey
    from orders
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey),
judged as (
    select *, players_foot is not null as foot_ok, players_height > 0 is true as height_ok,
           "players_marketValue" > 0 is true as value_ok
    from flat),
players as (
    select * exclude (club, o_orderkey, foot_ok, height_ok, value_ok) from judged
    where foot_ok and height_ok and value_ok),
market as (select * from players where season >= 2010),
aged as (select * from players where season >= 2005)
"""


@check(LAKE_SQL + "select * from players")
def silver_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.scan_players(spark, built_lake(spark, sf_dir).players)


@check(
    LAKE_SQL
    + """
select club as team, season, players_id,
       concat_ws(',', case when not foot_ok then 'foot' end,
                 case when not height_ok then 'height' end,
                 case when not value_ok then 'market_value' end) as reject_reason
from judged where not (foot_ok and height_ok and value_ok)
"""
)
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sources.scan_quarantine(spark, built_lake(spark, sf_dir).quarantine)
    return rows.select("team", "season", "players_id", "reject_reason")


@check(
    LAKE_SQL
    + """
select 'bronze' as layer, club as team, season, count(distinct o_orderkey // 1000) as rows_in,
       count(distinct o_orderkey // 1000) as rows_out, cast(0 as bigint) as rejected,
       count(distinct o_orderkey // 1000) - 1 as duplicate_files, cast(0 as bigint) as empty_squads
from judged group by club, season
union all
select 'silver', club, season, count(*), cast(count_if(foot_ok and height_ok and value_ok) as bigint),
       cast(count_if(not (foot_ok and height_ok and value_ok)) as bigint), 0, 0
from judged group by club, season
"""
)
def lake_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_quality(spark, built_lake(spark, sf_dir))


@check(
    LAKE_SQL
    + """
select club as team, count(distinct (o_orderkey // 1000, season)) as files,
       array_to_string(list_sort(list(distinct season)), ',') as seasons_present,
       array_to_string(list_sort(list_filter((select list(distinct season) from flat),
           lambda s: not list_contains(list(distinct season), s))), ',') as seasons_missing
from flat group by club
"""
)
def bronze_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = bronze_coverage(sources.scan_bronze(spark, built_lake(spark, sf_dir).bronze))
    return report.withColumns(
        {
            name: F.concat_ws(",", F.col(name).cast("array<string>"))
            for name in ("seasons_present", "seasons_missing")
        }
    )


@check(LAKE_SQL + "select * from players where team = 'AFC NATION7' and season = 2006")
def lookup_squad(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = sources.scan_players(spark, built_lake(spark, sf_dir).players)
    return sources.lookup_team_season(players, "AFC_NATION7", 2006)


@check(LAKE_SQL + "select * from players where players_id = '77' and season >= 2002")
def lookup_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = sources.scan_players(spark, built_lake(spark, sf_dir).players)
    return sources.lookup_player(players, "77", 2002)


def _gold(spark: SparkSession, sf_dir: str, group: str, name: str, *rounded: str) -> DataFrame:
    stored = presentation(spark, built_lake(spark, sf_dir), group, name)
    return stored.withColumns({column: F.round(column, 6) for column in rounded})


@check(
    LAKE_SQL
    + """
select players_id, players_name, team, season, "players_marketValue", rank from (
    select *, cast(row_number() over (partition by season order by "players_marketValue" desc,
              players_id, players_name, team) as integer) as rank from market)
where rank <= 10
"""
)
def gold_season_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "valuable_players", "season_ranking")


@check(
    LAKE_SQL
    + """
select * from (
    select *, cast(row_number() over (order by max_value desc, players_id, players_name) as integer)
              as rank
    from (select players_id, players_name, max("players_marketValue") as max_value from market
          group by all))
where rank <= 15
"""
)
def gold_overall_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "valuable_players", "overall_ranking")


@check(
    LAKE_SQL
    + """
select season, round(corr(players_age, "players_marketValue"), 6) as age_value_correlation,
       round(avg("players_marketValue"), 6) as avg_market_value
from market group by season
"""
)
def gold_age_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("age_value_correlation", "avg_market_value")
    return _gold(spark, sf_dir, "market_correlations", "age_correlation", *columns)


@check(
    LAKE_SQL
    + """
select season, players_position, round(avg("players_marketValue"), 6) as avg_value,
       count(*) as player_count
from market group by season, players_position
"""
)
def gold_position_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "market_correlations", "position_analysis", "avg_value")


@check(
    LAKE_SQL
    + """
select season, case when players_age < 20 then 'Under 20' when players_age < 24 then '20-23'
       when players_age < 28 then '24-27' when players_age < 32 then '28-31' else 'Over 31' end
       as age_group, round(avg("players_marketValue"), 6) as avg_value, count(*) as player_count
from market group by 1, 2
"""
)
def gold_age_groups_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "market_correlations", "age_groups_analysis", "avg_value")


def _injuries_sql(key: str) -> str:
    return f"""
select *, {sql_round("injured_players / total_players * 100")} as injury_rate from (
    select season, {key}, count(*) as total_players,
           cast(count_if(players_status = 'Injuried') as bigint) as injured_players
    from market group by season, {key})
"""


@check(LAKE_SQL + _injuries_sql("team"))
def gold_team_injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "injury_analysis", "team_injuries")


@check(LAKE_SQL + _injuries_sql("players_position"))
def gold_position_injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "injury_analysis", "position_injuries")


@check(
    LAKE_SQL
    + f"""
select team, season, {sql_round("avg(players_age)")} as avg_squad_age
from aged group by team, season
"""
)
def gold_team_age_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "squad_age_analysis", "team_age_evolution")


@check(
    LAKE_SQL
    + f"select season, {sql_round('avg(players_age)')} as avg_season_age from aged group by season"
)
def gold_season_age_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "squad_age_analysis", "season_age_evolution")


@check(
    LAKE_SQL
    + f"""
select team, {sql_round("avg(players_age)")} as overall_avg_age, min(players_age) as min_age,
       max(players_age) as max_age
from aged group by team
"""
)
def gold_team_age_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "squad_age_analysis", "team_age_stats")


TEAM_VALUES_SQL = (
    LAKE_SQL
    + """
, team_values as (
    select season, team, cast(sum("players_marketValue") as bigint) as total_value,
           count(*) as squad_size
    from market group by season, team)
"""
)


@check(
    TEAM_VALUES_SQL
    + f"""
select season, team, total_value, squad_size, previous_value,
       round((total_value - previous_value) / previous_value * 100, 6) as yoy_growth,
       {sql_round("total_value / squad_size")} as avg_player_value,
       cast(season - previous_season as integer) as season_gap
from (select *, lag(total_value) over (partition by team order by season) as previous_value,
             lag(season) over (partition by team order by season) as previous_season
      from team_values)
"""
)
def gold_yearly_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "market_evolution", "yearly_evolution", "yoy_growth")


@check(
    TEAM_VALUES_SQL
    + """
select *, round((final_value - initial_value) / initial_value * 100, 6) as total_growth_percent
from (select team, min(season) as start_season, max(season) as end_season,
             min_by(total_value, season) as initial_value,
             max_by(total_value, season) as final_value
      from team_values group by team)
"""
)
def gold_total_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "market_evolution", "total_growth", "total_growth_percent")
