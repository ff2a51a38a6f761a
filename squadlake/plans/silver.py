"""Silver: one clean row per player and season, and a quarantine for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.functions import cleaning
from squadlake.operators.nested import explode_players, flatten_player
from squadlake.operators.quality import quality_of_files, quality_report, reject_reason, row_counts
from squadlake.operators.sets import union_all_by_name
from squadlake.plans.bronze import FILE, KEYS, bronze_coverage, bronze_files, bronze_quality, bronze_totals
from squadlake.plans.lake import Lake
from squadlake.plans.together import run_together
from squadlake.sources.schemas import CORRUPT, PLAYER_FLAT
from squadlake.sources.snapshots import Change, written_counts
from squadlake.sources.tables import scan_bronze, scan_players, scan_players_flat

CARRIED = ("id", "updatedAt", "team", "season")
REASON = "reject_reason"


def flatten_squads(squads: DataFrame) -> DataFrame:
    """Players as rows, each with the rules it breaks, judged here once for all later tables.

    A damaged document may still give players, with fields missing. They are kept, and
    rejected for the document they come from.
    """
    keep = (*CARRIED, CORRUPT)
    flat = flatten_player(explode_players(squads, keep), keep)
    return flat.withColumn(REASON, reject_reason(player_rules())).drop(CORRUPT)


def cleaned_columns() -> dict[str, Column]:
    """The cleaning rules by column.

    Two rules would find nothing left to do and are not applied twice over: the status
    labels already begin with a capital, and ``clean_club_name`` leaves no empty origin
    for ``fill_signed_from``.
    """
    status = cleaning.clean_status(cleaning.default_status("players_status"))
    return {
        "players_age": cleaning.parse_age("players_age"),
        "players_height": cleaning.parse_height("players_height"),
        "players_foot": cleaning.capitalize_first("players_foot"),
        "players_signedFrom": cleaning.clean_club_name("players_signedFrom"),
        "players_marketValue": cleaning.parse_market_value("players_marketValue"),
        "players_status": status,
        "player_first_nationality": cleaning.nth_or_default("players_nationality", 1),
        "player_second_nationality": cleaning.nth_or_default("players_nationality", 2),
    }


def player_rules() -> dict[str, Column]:
    """What makes a flat row usable, stated on the raw fields."""
    cleaned = cleaned_columns()
    return {
        "document": F.col(CORRUPT).isNull(),
        "foot": F.col("players_foot") != "",
        "height": cleaned["players_height"] > 0,
        "market_value": cleaned["players_marketValue"] > 0,
        "season": F.col("season").isNotNull(),
    }


def clean_players(flat: DataFrame, team_name_mode: str = "token") -> DataFrame:
    """Valid players, typed and cleaned, under the readable team name."""
    names = cleaned_columns() | {"team": cleaning.normalize_team_name("team", team_name_mode)}
    return (
        flat.where(F.col(REASON).isNull())
        .withColumns(names)
        .drop(
            REASON,
            "id",
            "updatedAt",
            "players_dateOfBirth",
            "players_joinedOn",
            "players_nationality",
            "players_currentClub",
        )
    )


def rejected_players(flat: DataFrame) -> DataFrame:
    return flat.where(F.col(REASON).isNotNull())


def of_seasons(rows: DataFrame, seasons: Sequence[int | None] | None) -> DataFrame:
    """Rows of these seasons, NULL for none among them; all rows if no seasons are given."""
    if seasons is None:
        return rows
    return rows.where(reduce(or_, [F.col("season").eqNullSafe(season) for season in seasons], F.lit(False)))


class CountsDiffer(RuntimeError):
    """Rows were lost or made between two writes."""


def run_silver(
    spark: SparkSession,
    lake: Lake,
    team_name_mode: str = "token",
    seasons: Sequence[int | None] | None = None,
) -> DataFrame:
    """Bronze to flat to clean, all or only ``seasons``. Each write is narrow: bronze already lies by season.

    The three tables are committed together, once the numbers of rows counted while they were
    written agree: flat is what is clean and what is rejected.
    """
    change = Change(spark, lake.layer("silver"))
    write = partial(change.write, rebalance=False, touched=seasons)
    squads = of_seasons(scan_bronze(spark, lake.bronze), seasons)
    counts = write(flatten_squads(squads), "players_flat", counted=row_counts(flat_rules()))
    flat = of_seasons(change.read("players_flat", PLAYER_FLAT), seasons)
    tables = {"players": clean_players(flat, team_name_mode), "quarantine": rejected_players(flat)}
    count = {"rows": F.count(F.lit(1))}
    run_together(
        spark,
        [partial(write, rows, name, counted=count, bloom_filters=["players_id"]) for name, rows in tables.items()],
    )
    written = {name: change.tables[name][0].counts["rows"] for name in tables}
    if written != {"players": counts["rows_out"], "quarantine": counts["rejected"]}:
        raise CountsDiffer(f"flat has {dict(counts)}, but {written} were written")
    change.commit()
    return scan_players(spark, lake.players)


def flat_rules() -> dict[str, Column]:
    return {REASON: F.col(REASON).isNull()}


def silver_quality(flat: DataFrame) -> DataFrame:
    return quality_report(flat, "silver", KEYS, flat_rules())


def lake_quality(spark: SparkSession, lake: Lake) -> DataFrame:
    """Run statistics of both layers, one row per (layer, team, season)."""
    return union_all_by_name(
        [
            bronze_quality(scan_bronze(spark, lake.bronze)),
            silver_quality(scan_players_flat(spark, lake.players_flat)),
        ]
    )


def written_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    """``layer, table, write, partitions, counted, rows``: what was counted while tables were written, from their commits."""
    counts = [
        written_counts(spark, lake.layer(layer)).select(F.lit(layer).alias("layer"), "*")
        for layer in ("bronze", "silver")
    ]
    return union_all_by_name(counts).select(
        "layer", "table", "write", "partitions", F.explode("counts").alias("counted", "rows")
    )


def run_reports(spark: SparkSession, lake: Lake) -> None:
    """Counts of both layers, coverage by team and the totals of the run, as tables committed together.

    Bronze is scanned once, three columns of it, for a table of its files that three reports are made of. What
    was counted while tables were written is taken from their commits.
    """
    change = Change(spark, lake.layer("reports"))

    def write(name: str, report: DataFrame) -> None:
        change.write(report, name, (), (), rebalance=False)

    write("files", bronze_files(scan_bronze(spark, lake.bronze)))
    files = change.read("files")
    silver = silver_quality(scan_players_flat(spark, lake.players_flat))
    reports = {
        "quality": union_all_by_name([quality_of_files(files, "bronze", KEYS, FILE), silver]),
        "coverage": bronze_coverage(files),
        "run_totals": bronze_totals(files),
        "written_rows": written_rows(spark, lake),
    }
    run_together(spark, [partial(write, name, report) for name, report in reports.items()])
    change.commit()
