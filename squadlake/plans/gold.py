"""Gold: the twelve analytic tables.

Ten of them need only sub-totals, so silver is aggregated twice, by (season, team)
and by (season, position, age band), and those two small tables are written by season and
read back; a run over some seasons makes sub-totals of these alone. The two rankings read silver from
the first season in use, with three to five columns.

Tables are stored unsorted, since files have no order to rely on when read;
``presentation`` sorts what a reader looks at.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake import fixed_values as fixed
from squadlake.functions.bands import age_band, band_order
from squadlake.functions.numeric import co_moments
from squadlake.operators.growth import first_last_by_order, yoy_growth
from squadlake.operators.profiles import (
    avg_by_group,
    conditional_rate,
    corr_from_moments,
    profile_by_category,
    stats_by_group,
    total_by_group,
)
from squadlake.operators.ranking import top_entities, top_n_per_group
from squadlake.plans.lake import Lake
from squadlake.plans.silver import of_seasons
from squadlake.plans.together import run_together
from squadlake.sources.layers import scan_season_range
from squadlake.sources.snapshots import Change
from squadlake.sources.tables import read_gold_table, scan_players

ENTITY = ("players_id", "players_name")
SUBTOTALS = "subtotals"


@dataclass(frozen=True)
class Floors:
    """First season of the market tables and of the age tables."""

    market: int = fixed.MARKET_FLOOR
    age: int = fixed.SQUAD_AGE_FLOOR

    @property
    def lowest(self) -> int:
        return min(self.market, self.age)


@dataclass(frozen=True)
class Inputs:
    """What the tables are computed from, each already cut to its floor."""

    players: DataFrame
    market_teams: DataFrame
    market_categories: DataFrame
    age_teams: DataFrame
    entity: tuple[str, ...] = ENTITY


def team_subtotals(players: DataFrame) -> DataFrame:
    """One row per (season, team): everything the team tables need."""
    return players.groupBy("season", "team").agg(
        F.count(F.lit(1)).alias("squad_size"),
        F.sum("players_marketValue").alias("value_total"),
        F.count_if(F.col("players_status") == fixed.INJURED).alias("injured"),
        F.sum("players_age").alias("age_total"),
        F.count("players_age").alias("age_known"),
        F.min("players_age").alias("age_lowest"),
        F.max("players_age").alias("age_highest"),
        F.count("players_marketValue").alias("value_rows"),
        *[moment.alias(name) for name, moment in co_moments("players_age", "players_marketValue").items()],
    )


def category_subtotals(players: DataFrame) -> DataFrame:
    """One row per (season, position, age band); its size does not depend on the players."""
    return players.groupBy(
        "season", "players_position", age_band("players_age").alias("age_group")
    ).agg(
        F.count(F.lit(1)).alias("player_count"),
        F.sum("players_marketValue").alias("value_total"),
        F.count_if(F.col("players_status") == fixed.INJURED).alias("injured"),
    )


def season_ranking(inputs: Inputs) -> DataFrame:
    columns = [*inputs.entity, "team", "season", "players_marketValue"]
    tie_break = [*inputs.entity, "team"]
    return top_n_per_group(
        inputs.players.select(*columns), ["season"], "players_marketValue", fixed.SEASON_TOP, tie_break
    )


def overall_ranking(inputs: Inputs) -> DataFrame:
    return top_entities(inputs.players, inputs.entity, "players_marketValue", fixed.OVERALL_TOP)


def age_correlation(inputs: Inputs) -> DataFrame:
    return corr_from_moments(inputs.market_teams, ["season"])


def _profile(inputs: Inputs, category: str) -> DataFrame:
    return profile_by_category(
        inputs.market_categories, ["season", category], "value_total", rows="player_count"
    )


def position_analysis(inputs: Inputs) -> DataFrame:
    return _profile(inputs, "players_position")


def age_groups_analysis(inputs: Inputs) -> DataFrame:
    return _profile(inputs, "age_group")


def team_injuries(inputs: Inputs) -> DataFrame:
    return conditional_rate(
        inputs.market_teams, ["season", "team"], hits="injured", rows="squad_size"
    )


def position_injuries(inputs: Inputs) -> DataFrame:
    return conditional_rate(
        inputs.market_categories,
        ["season", "players_position"],
        hits="injured",
        rows="player_count",
    )


def team_age_evolution(inputs: Inputs) -> DataFrame:
    keys = ["team", "season"]
    return avg_by_group(inputs.age_teams, keys, "age_total", "avg_squad_age", rows="age_known")


def season_age_evolution(inputs: Inputs) -> DataFrame:
    return avg_by_group(inputs.age_teams, ["season"], "age_total", "avg_season_age", rows="age_known")


def team_age_stats(inputs: Inputs) -> DataFrame:
    return stats_by_group(
        inputs.age_teams,
        ["team"],
        "age_total",
        rows="age_known",
        lowest="age_lowest",
        highest="age_highest",
    )


def team_values(inputs: Inputs) -> DataFrame:
    return total_by_group(inputs.market_teams, ["season", "team"], "value_total", rows="squad_size")


def yearly_evolution(inputs: Inputs) -> DataFrame:
    return yoy_growth(team_values(inputs), "team", "season")


def total_growth(inputs: Inputs) -> DataFrame:
    return first_last_by_order(team_values(inputs), "team", "season")


@dataclass(frozen=True)
class GoldTable:
    group: str
    name: str
    build: Callable[[Inputs], DataFrame]
    order_by: tuple[str, ...] = field(default=())

    def presentation_order(self) -> list[Column]:
        """``-name`` sorts downwards; age bands sort by age, not by their label."""

        def key(name: str) -> Column:
            return band_order(name) if name == "age_group" else F.col(name)

        return [
            key(name[1:]).desc() if name.startswith("-") else key(name).asc()
            for name in self.order_by
        ]


# Groups, names and reading order of the tables.
GOLD_TABLES = (
    GoldTable("valuable_players", "season_ranking", season_ranking, ("season", "rank")),
    GoldTable("valuable_players", "overall_ranking", overall_ranking, ("rank",)),
    GoldTable("market_correlations", "age_correlation", age_correlation, ("season",)),
    GoldTable(
        "market_correlations", "position_analysis", position_analysis, ("season", "-avg_value")
    ),
    GoldTable(
        "market_correlations", "age_groups_analysis", age_groups_analysis, ("season", "age_group")
    ),
    GoldTable("injury_analysis", "team_injuries", team_injuries, ("season", "-injured_players")),
    GoldTable(
        "injury_analysis", "position_injuries", position_injuries, ("season", "-injury_rate")
    ),
    GoldTable("squad_age_analysis", "team_age_evolution", team_age_evolution, ("team", "season")),
    GoldTable("squad_age_analysis", "season_age_evolution", season_age_evolution, ("season",)),
    GoldTable("squad_age_analysis", "team_age_stats", team_age_stats, ("-overall_avg_age",)),
    GoldTable("market_evolution", "yearly_evolution", yearly_evolution, ("team", "season")),
    GoldTable("market_evolution", "total_growth", total_growth, ("-total_growth_percent",)),
)


def gold_inputs(
    players: DataFrame,
    teams: DataFrame,
    categories: DataFrame,
    floors: Floors = Floors(),
    entity: tuple[str, ...] = ENTITY,
) -> Inputs:
    return Inputs(
        players=scan_season_range(players, floors.market),
        market_teams=scan_season_range(teams, floors.market),
        market_categories=scan_season_range(categories, floors.market),
        age_teams=scan_season_range(teams, floors.age),
        entity=entity,
    )


def write_subtotals(
    change: Change, players: DataFrame, seasons: Sequence[int | None] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Team and category sub-totals of all seasons, or of ``seasons`` anew, as tables to start from."""
    touched = of_seasons(players, seasons)
    subtotals = {"team": team_subtotals(touched), "category": category_subtotals(touched)}
    run_together(
        change.spark,
        [
            partial(change.write, rows, f"{SUBTOTALS}/{name}", cluster_by=(), rebalance=False, touched=seasons)
            for name, rows in subtotals.items()
        ],
    )
    teams, categories = (
        change.read(f"{SUBTOTALS}/{name}", _ddl(rows)) for name, rows in subtotals.items()
    )
    return teams, categories


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)


def run_gold(
    spark: SparkSession,
    lake: Lake,
    floors: Floors = Floors(),
    entity: tuple[str, ...] = ENTITY,
    seasons: Sequence[int | None] | None = None,
) -> None:
    """Write all tables and commit them together. An error in one ends the run; readers keep the tables of before.

    ``entity`` says who a player is: id and name, or only the name, which merges
    namesakes. ``seasons`` are those that changed since the last run; the others' sub-totals are taken over.
    """
    change = Change(spark, lake.gold)
    players = scan_players(spark, lake.players)
    inputs = gold_inputs(players, *write_subtotals(change, players, seasons), floors, entity)
    run_together(
        spark,
        [
            partial(change.write, table.build(inputs), f"{table.group}/{table.name}", (), (), rebalance=False)
            for table in GOLD_TABLES
        ],
    )
    change.commit()


def presentation(spark: SparkSession, lake: Lake, group: str, name: str) -> DataFrame:
    """A gold table in its reading order."""
    table = next(t for t in GOLD_TABLES if (t.group, t.name) == (group, name))
    stored = read_gold_table(spark, lake.gold, group, name)
    return stored.orderBy(*table.presentation_order())
