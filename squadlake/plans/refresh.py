"""A whole run from the staging folder, of everything or of the seasons whose files changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from squadlake.plans.bronze import file_squads
from squadlake.plans.gold import ENTITY, Floors, run_gold
from squadlake.plans.lake import Lake
from squadlake.plans.silver import run_reports, run_silver
from squadlake.sources.manifest import FILES, changed_files, list_files
from squadlake.sources.snapshots import Change
from squadlake.sources.squads import scan_squad_json

LAYERS = ("bronze", "silver", "gold", "reports", "state")


def run_lake(
    spark: SparkSession,
    staging: str,
    lake: Lake,
    layout: str = "auto",
    team_name_mode: str = "token",
    floors: Floors = Floors(),
    entity: tuple[str, ...] = ENTITY,
    refresh: bool = False,
    glob: str = "*.json",
) -> Sequence[int | None] | None:
    """Build all layers; with ``refresh`` only seasons with new, changed or deleted files since the last complete run.

    Gives the seasons rewritten, None for all; with nothing changed nothing is written. Files are listed before they are
    read and the list is committed last: a run that ends half-way leaves the old list, so the next refresh
    does its seasons again, in every layer. A refresh takes the same settings as the run before it.
    """
    state = Change(spark, lake.layer("state"))
    listed = list_files(spark, staging, glob)
    state.write(listed, "files", (), (), rebalance=False)
    seasons = None
    if refresh and state.base is not None:
        before = state.base_table("files", FILES)
        changes = changed_files(state.read("files", FILES), before)
        # As many rows as there are seasons.
        seasons = [row["season"] for row in changes.select("season").distinct().collect()]
        if not seasons:
            return seasons
    squads = scan_squad_json(spark, staging, layout, glob, seasons)
    file_squads(squads, lake, seasons)
    run_silver(spark, lake, team_name_mode, seasons)
    run_gold(spark, lake, floors, entity, seasons)
    run_reports(spark, lake)
    state.commit()
    return seasons
