"""Bronze: raw squad documents, filed by season and team."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.operators.coverage import coverage_report, run_totals
from squadlake.operators.quality import file_counts, quality_of_files, row_counts
from squadlake.plans.lake import Lake
from squadlake.sources.schemas import CORRUPT
from squadlake.sources.snapshots import Change
from squadlake.sources.squads import scan_squad_json
from squadlake.sources.tables import scan_bronze

KEYS = ("team", "season")
FILE = "source_file"


def document_rules() -> dict[str, Column]:
    """A document is usable when it parsed and its place gave a team and a season."""
    return {
        "corrupt": F.col(CORRUPT).isNull(),
        "team": F.col("team").isNotNull(),
        "season": F.col("season").isNotNull(),
    }


def run_bronze(
    spark: SparkSession, staging: str, lake: Lake, layout: str = "auto"
) -> DataFrame:
    file_squads(scan_squad_json(spark, staging, layout), lake)
    return scan_bronze(spark, lake.bronze)


def file_squads(
    squads: DataFrame, lake: Lake, seasons: Sequence[int | None] | None = None
) -> Mapping[str, int]:
    """Commit squads as bronze, or with ``seasons`` those seasons of it; gives the counts of what was written.

    Thousands of small documents of mixed seasons share an input task, so this is the one layer that
    needs the shuffle.
    """
    change = Change(squads.sparkSession, lake.layer("bronze"))
    counts = change.write(squads, "squads", touched=seasons, counted=row_counts(document_rules()))
    change.commit()
    return counts


def bronze_files(squads: DataFrame) -> DataFrame:
    """Documents of every file, which all reports of this layer can be made of."""
    return file_counts(squads, KEYS, document_rules(), FILE, "players.id")


def bronze_quality(squads: DataFrame) -> DataFrame:
    return quality_of_files(bronze_files(squads), "bronze", KEYS, FILE)


def bronze_coverage(squads: DataFrame) -> DataFrame:
    """From bronze or from its ``bronze_files``."""
    return coverage_report(squads)


def bronze_totals(squads: DataFrame) -> DataFrame:
    """Teams, files, and squads of a team and season there and missing, of a whole run."""
    return run_totals(squads)
