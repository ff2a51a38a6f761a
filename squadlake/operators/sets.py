"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    if not frames:
        raise ValueError("nothing to unite: pass at least one DataFrame")
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=allow_missing), frames
    )
