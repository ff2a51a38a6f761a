"""Arithmetic that stays NULL, not an error, where there is no answer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from squadlake.functions.cleaning import as_column


def growth_percent(current: str | Column, base: str | Column) -> Column:
    """Change from ``base`` in percent; NULL when ``base`` is 0 or missing."""
    current, base = as_column(current), as_column(base)
    return F.try_divide(current - base, base) * 100


def ratio_percent(part: str | Column, whole: str | Column, places: int = 2) -> Column:
    return F.round(F.try_divide(as_column(part), as_column(whole)) * 100, places)


def co_moments(x: str | Column, y: str | Column) -> dict[str, Column]:
    """Aggregates: number, sums, squares and products of the pairs of whole numbers in which both are present.

    Exact, in decimals, so sub-totals add up to the very totals of all rows, in any order.
    """
    x, y = (as_column(column).cast("decimal(19, 0)") for column in (x, y))
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    sums = {"x": both_x, "y": both_y, "xx": both_x * both_x, "xy": x * y, "yy": both_y * both_y}
    return {"pairs": F.count(both_x)} | {f"sum_{name}": F.try_sum(term) for name, term in sums.items()}


def corr_of_moments(moments: Mapping[str, Column]) -> Column:
    """Correlation from ``co_moments``; NULL for a constant value, a single pair, or sums beyond 38 digits.

    Sums of squares are first moved to whole numbers next to the means, still exactly, so that nothing is left to
    cancel out in the doubles that follow, however large the values and small their spread.
    """
    n = moments["pairs"].cast("decimal(19, 0)")
    sum_x, sum_y = moments["sum_x"], moments["sum_y"]
    mean_x, mean_y = (
        F.floor(F.try_divide(total.cast("double"), n.cast("double"))).cast("decimal(19, 0)")
        for total in (sum_x, sum_y)
    )

    def centred(product: Column, a: Column, mean_a: Column, b: Column, mean_b: Column) -> Column:
        # Of the products (a - mean_a) * (b - mean_b): all of a times b, less the means' shares.
        less = F.try_add(F.try_multiply(mean_b, a), F.try_multiply(mean_a, b))
        return F.try_add(F.try_subtract(product, less), F.try_multiply(n, F.try_multiply(mean_a, mean_b)))

    rest_x = F.try_subtract(sum_x, F.try_multiply(n, mean_x)).cast("double")
    rest_y = F.try_subtract(sum_y, F.try_multiply(n, mean_y)).cast("double")

    def spread(sides: str, rest_a: Column, rest_b: Column) -> Column:
        a, b = ({"x": (sum_x, mean_x), "y": (sum_y, mean_y)}[side] for side in sides)
        whole = centred(moments[f"sum_{sides}"], *a, *b).cast("double")
        return whole - F.try_divide(rest_a * rest_b, n.cast("double"))

    spread_x, spread_y = spread("xx", rest_x, rest_x), spread("yy", rest_y, rest_y)
    return F.try_divide(spread("xy", rest_x, rest_y), F.sqrt(spread_x) * F.sqrt(spread_y))


def pearson(x: str | Column, y: str | Column) -> Column:
    """Aggregate: correlation of the pairs in which both values are present.

    ``corr`` raises under ANSI mode when a value is constant within the group.
    This form gives NULL there, and for groups of one pair. Both kinds of moment
    are mergeable, so the map side still reduces each group to one row.
    """
    x, y = as_column(x), as_column(y)
    spread_x = F.var_pop(F.when(y.isNotNull(), x))
    spread_y = F.var_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(spread_x) * F.sqrt(spread_y))
