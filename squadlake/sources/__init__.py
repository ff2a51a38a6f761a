from squadlake.sources.layers import (
    lookup_player,
    lookup_team_season,
    output_file_policy,
    scan_season_range,
    write_bronze,
    write_layer,
    write_parquet_overwrite,
)
from squadlake.sources.manifest import changed_files, list_files
from squadlake.sources.publishing import CopyDiffers, Table, publish_layer, publish_tables
from squadlake.sources.snapshots import (
    Change,
    current_version,
    expire_versions,
    read_table,
    replace_table,
    written_counts,
)
from squadlake.sources.squads import scan_squad_json
from squadlake.sources.tables import (
    read_gold_table,
    scan_bronze,
    scan_players,
    scan_players_flat,
    scan_quarantine,
)

__all__ = [
    "Change",
    "CopyDiffers",
    "Table",
    "changed_files",
    "current_version",
    "expire_versions",
    "list_files",
    "lookup_player",
    "lookup_team_season",
    "output_file_policy",
    "publish_layer",
    "publish_tables",
    "read_gold_table",
    "read_table",
    "replace_table",
    "scan_bronze",
    "scan_players",
    "scan_players_flat",
    "scan_quarantine",
    "scan_season_range",
    "scan_squad_json",
    "write_bronze",
    "write_layer",
    "write_parquet_overwrite",
    "written_counts",
]
