"""The tables of a lake, read as committed; see ``snapshots``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from squadlake.sources.schemas import BRONZE, PLAYER_CLEAN, PLAYER_FLAT, QUARANTINE
from squadlake.sources.snapshots import read_table


def _scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``path`` is ``<layer>/<table>``; the schema is given, so a team named ``1899`` stays text."""
    layer, _, table = path.rstrip("/").rpartition("/")
    return read_table(spark, layer, table, schema)


def scan_bronze(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, BRONZE)


def scan_players_flat(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, PLAYER_FLAT)


def scan_players(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, PLAYER_CLEAN)


def scan_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, QUARANTINE)


def read_gold_table(spark: SparkSession, gold: str, group: str, name: str) -> DataFrame:
    return read_table(spark, gold, f"{group}/{name}")
