"""Schemas of the layers, as DDL."""

from __future__ import annotations

# Field names and order of a raw squad document. All scalars arrive as text.
PLAYER_FIELDS = (
    "id",
    "name",
    "position",
    "dateOfBirth",
    "age",
    "nationality",
    "currentClub",
    "height",
    "foot",
    "joinedOn",
    "signedFrom",
    "marketValue",
    "status",
)


def _type_of(field: str) -> str:
    return "array<string>" if field == "nationality" else "string"


SQUAD = (
    "id string, players array<struct<"
    + ", ".join(f"{field}: {_type_of(field)}" for field in PLAYER_FIELDS)
    + ">>, updatedAt string"
)

CORRUPT = "_corrupt_record"

BRONZE = f"{SQUAD}, {CORRUPT} string, source_file string, team string, season int"

PLAYER_FLAT = (
    "id string, updatedAt string, "
    + ", ".join(f"players_{field} {_type_of(field)}" for field in PLAYER_FIELDS)
    + ", team string, season int, reject_reason string"
)

PLAYER_CLEAN = """
    players_id string,
    players_name string,
    players_position string,
    players_age int,
    players_height int,
    players_foot string,
    players_signedFrom string,
    players_marketValue bigint,
    players_status string,
    player_first_nationality string,
    player_second_nationality string,
    team string,
    season int
"""

QUARANTINE = PLAYER_FLAT
