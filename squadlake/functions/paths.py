"""Team and season from where a squad document lies.

Layout: ``<root>/<anything>_<year>/<Team>_<number>_<year>.json``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squadlake.functions.cleaning import as_column

# The name ends before the first "_<digit>", the year ends the directory.
TEAM_END = r"_\d"
SEASON_END = r"_(\d+)$"


def decode_path(path: str | Column) -> Column:
    """Undo the percent-encoding of ``_metadata`` paths (a plus sign is a plus sign)."""
    path = as_column(path)
    return F.when(
        F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    ).otherwise(path)


def team_from_file_name(file_name: str | Column) -> Column:
    return F.split(as_column(file_name), TEAM_END, 2).getItem(0)


def season_from_path(path: str | Column) -> Column:
    """The year as int, NULL when the directory does not end in ``_<digits>``."""
    path = as_column(path)
    folders = F.substring_index(path, "/", -2)
    folder = F.when(F.contains(folders, F.lit("/")), F.substring_index(folders, "/", 1))
    return F.regexp_extract(folder, SEASON_END, 1).try_cast("int")


def file_name_of(path: str | Column) -> Column:
    return F.substring_index(as_column(path), "/", -1)
