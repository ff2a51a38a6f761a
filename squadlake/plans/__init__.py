from squadlake.plans.bronze import (
    bronze_coverage,
    bronze_quality,
    bronze_totals,
    file_squads,
    run_bronze,
)
from squadlake.plans.gold import GOLD_TABLES, Floors, presentation, run_gold
from squadlake.plans.lake import Lake
from squadlake.plans.publish import publish_lake
from squadlake.plans.refresh import LAYERS, run_lake
from squadlake.plans.silver import (
    lake_quality,
    run_reports,
    run_silver,
    silver_quality,
    written_rows,
)

__all__ = [
    "GOLD_TABLES",
    "LAYERS",
    "Floors",
    "Lake",
    "bronze_coverage",
    "bronze_quality",
    "bronze_totals",
    "file_squads",
    "lake_quality",
    "presentation",
    "publish_lake",
    "run_bronze",
    "run_gold",
    "run_lake",
    "run_reports",
    "run_silver",
    "silver_quality",
    "written_rows",
]
