from squadlake.operators.coverage import (
    coverage_gaps,
    coverage_report,
    list_seasons,
    run_totals,
    seasons_by_team,
)
from squadlake.operators.fingerprints import fingerprints, row_hash
from squadlake.operators.growth import first_last_by_order, yoy_growth
from squadlake.operators.nested import (
    explode_players,
    explode_rows,
    flatten_player,
    flatten_struct,
)
from squadlake.operators.profiles import (
    avg_by_group,
    conditional_rate,
    corr_by_group,
    corr_from_moments,
    moments_by_group,
    profile_by_band,
    profile_by_category,
    stats_by_group,
    total_by_group,
)
from squadlake.operators.quality import (
    file_counts,
    observed,
    quality_of_files,
    quality_report,
    quarantine,
    reject_reason,
    row_counts,
    valid_rows,
)
from squadlake.operators.ranking import (
    max_per_entity,
    rank_at_most,
    top_entities,
    top_n_overall,
    top_n_per_group,
)
from squadlake.operators.sets import union_all_by_name

__all__ = [
    "avg_by_group",
    "conditional_rate",
    "corr_by_group",
    "corr_from_moments",
    "coverage_gaps",
    "coverage_report",
    "explode_players",
    "explode_rows",
    "file_counts",
    "fingerprints",
    "first_last_by_order",
    "flatten_player",
    "flatten_struct",
    "list_seasons",
    "max_per_entity",
    "moments_by_group",
    "observed",
    "profile_by_band",
    "profile_by_category",
    "quality_of_files",
    "quality_report",
    "quarantine",
    "rank_at_most",
    "reject_reason",
    "row_counts",
    "row_hash",
    "run_totals",
    "seasons_by_team",
    "stats_by_group",
    "top_entities",
    "top_n_overall",
    "top_n_per_group",
    "total_by_group",
    "union_all_by_name",
    "valid_rows",
    "yoy_growth",
]
