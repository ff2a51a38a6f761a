"""Publishing a lake to another store."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession

from squadlake.plans.gold import GOLD_TABLES
from squadlake.plans.lake import Lake
from squadlake.plans.together import run_together
from squadlake.sources import schemas
from squadlake.sources.publishing import Table, publish_tables


def layer_tables() -> dict[str, list[Table]]:
    """The tables of each layer that are published."""
    return {
        "bronze": [Table("squads", schemas.BRONZE)],
        "silver": [
            Table("players_flat", schemas.PLAYER_FLAT),
            Table("players", schemas.PLAYER_CLEAN),
            Table("quarantine", schemas.QUARANTINE),
        ],
        "gold": [Table(f"{t.group}/{t.name}", None, (), ()) for t in GOLD_TABLES],
    }


def publish_lake(spark: SparkSession, lake: Lake, destination: Lake, verify: bool = False) -> None:
    """Bring another lake up to date, for example from cluster storage to an object store; see ``publish_tables``."""
    copies = [
        partial(publish_tables, spark, lake.layer(layer), destination.layer(layer), tables, verify)
        for layer, tables in layer_tables().items()
    ]
    run_together(spark, copies)
