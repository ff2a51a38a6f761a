from squadlake.functions.bands import age_band, band, band_order
from squadlake.functions.cleaning import (
    blank_to_null,
    capitalize_first,
    clean_club_name,
    clean_status,
    default_status,
    fill_signed_from,
    normalize_team_name,
    nth_or_default,
    parse_age,
    parse_height,
    parse_market_value,
    strip,
)
from squadlake.functions.numeric import (
    co_moments,
    corr_of_moments,
    growth_percent,
    pearson,
    ratio_percent,
)
from squadlake.functions.paths import (
    decode_path,
    file_name_of,
    season_from_path,
    team_from_file_name,
)

__all__ = [
    "age_band",
    "band",
    "band_order",
    "blank_to_null",
    "capitalize_first",
    "clean_club_name",
    "clean_status",
    "co_moments",
    "corr_of_moments",
    "decode_path",
    "default_status",
    "file_name_of",
    "fill_signed_from",
    "growth_percent",
    "normalize_team_name",
    "nth_or_default",
    "parse_age",
    "parse_height",
    "parse_market_value",
    "pearson",
    "ratio_percent",
    "season_from_path",
    "strip",
    "team_from_file_name",
]
