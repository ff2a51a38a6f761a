"""Nested squads to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadlake.sources.schemas import PLAYER_FIELDS


def explode_rows(df: DataFrame, array: str, element: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element; rows with a NULL or empty array give none."""
    return df.select(*keep, F.explode(array).alias(element))


def flatten_struct(
    df: DataFrame, struct: str, fields: Sequence[str], prefix: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Struct fields as columns named ``<prefix><field>``."""
    return df.select(*keep, *[F.col(f"{struct}.{name}").alias(f"{prefix}{name}") for name in fields])


def explode_players(squads: DataFrame, keep: Sequence[str] = ("id", "updatedAt")) -> DataFrame:
    return explode_rows(squads, "players", "player", keep)


def flatten_player(
    exploded: DataFrame, keep: Sequence[str] = ("id", "updatedAt")
) -> DataFrame:
    return flatten_struct(exploded, "player", PLAYER_FIELDS, "players_", keep)
