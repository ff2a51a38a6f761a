"""Inclusive value bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from squadlake import fixed_values as fixed
from squadlake.functions.cleaning import as_column

Band = tuple[str, int | float | None, int | float | None]


def _within(value: Column, low, high) -> Column:
    if low is None:
        return value <= high
    if high is None:
        return value >= low
    return value.between(low, high)


def _first_match(conditions: Sequence[Column], results: Sequence, fallback) -> Column:
    cases = [F.when(condition, result) for condition, result in zip(conditions, results)]
    return F.coalesce(*cases, F.lit(fallback))


def band(
    value: str | Column,
    bands: Sequence[Band] = fixed.AGE_BANDS,
    otherwise: str = fixed.OLDEST_BAND,
    null_label: str | None = None,
) -> Column:
    """Label of the first band that holds the value.

    NULL falls into ``otherwise`` unless ``null_label`` names a band of its own.
    """
    value = as_column(value)
    conditions = [_within(value, low, high) for _, low, high in bands]
    labels = [label for label, _, _ in bands]
    if null_label is not None:
        conditions.insert(0, value.isNull())
        labels.insert(0, null_label)
    return _first_match(conditions, labels, otherwise)


def band_order(label: str | Column, bands: Sequence[Band] = fixed.AGE_BANDS) -> Column:
    """Position of a band label from 1 upwards; labels outside ``bands`` come last."""
    label = as_column(label)
    labels = [name for name, _, _ in bands]
    return _first_match(
        [label == name for name in labels], range(1, len(labels) + 1), len(labels) + 1
    )


def age_band(age: str | Column, null_label: str | None = None) -> Column:
    return band(age, null_label=null_label)
