"""The library at work on the generic star-schema tables, each query beside its SQL."""

from checks import analytics, lake, rules, stores, tables
from checks.registry import REGISTRY

__all__ = ["REGISTRY", "analytics", "lake", "rules", "stores", "tables"]
