"""Cleaning rules for player fields.

Every rule is one native Column expression: it stays inside whole-stage code
generation, needs no Python worker, and gives NULL (never an error) for text it
cannot read, so one bad row cannot stop a job over billions of them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from squadlake import fixed_values as fixed


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(text: str | Column) -> Column:
    """NULL for the empty string, the text itself otherwise."""
    return F.nullif(as_column(text), F.lit(""))


def strip(text: str | Column) -> Column:
    """Drop white space of any script at both ends."""
    return F.btrim(as_column(text), F.lit(fixed.WHITESPACE))


def parse_market_value(amount: str | Column) -> Column:
    """Whole currency units from texts such as ``€600k`` or ``€45.00m``.

    The arithmetic is decimal, so ``€2.01m`` is 2,010,000 and not one less.
    Missing text is 0; text that is no amount (``-``, ``€1.20bn``) is NULL.
    """
    amount = as_column(amount)

    def has_any(marks: str) -> Column:
        # In the text as it is: lower case of text with a currency sign is slow, and would be made for every use.
        return reduce(or_, [F.contains(amount, F.lit(mark)) for mark in marks])

    unit = (
        F.when(has_any(fixed.THOUSAND_MARKS), 1_000)
        .when(has_any(fixed.MILLION_MARKS), 1_000_000)
        .otherwise(1)
    )
    # One pass drops the marks and makes rare white space plain; the cast trims plain space.
    rare = "".join(space for space in fixed.WHITESPACE if space > " ")
    marks = fixed.CURRENCY_SIGN + fixed.THOUSAND_MARKS + fixed.MILLION_MARKS
    number = F.translate(amount, rare + marks, " " * len(rare)).try_cast("decimal(20,6)")
    return F.when(amount != "", (number * unit).try_cast("bigint")).otherwise(F.lit(0))


def parse_height(height: str | Column) -> Column:
    """Centimetres from ``1,85m``: the first three characters once commas are gone."""
    digits = F.replace(as_column(height), F.lit(","), F.lit(""))
    return F.substring(digits, 1, 3).try_cast("int")


def parse_age(age: str | Column) -> Column:
    return as_column(age).try_cast("int")


def nth_or_default(array: str | Column, position: int, default: str = fixed.NO_NATIONALITY) -> Column:
    """Element at a 1-based position, or a default when the array is too short or NULL."""
    return F.coalesce(F.try_element_at(as_column(array), F.lit(position)), F.lit(default))


def clean_club_name(club: str | Column) -> Column:
    """The text before the first colon; ``No team`` when that leaves nothing."""
    head = strip(F.substring_index(as_column(club), ":", 1))
    return F.coalesce(blank_to_null(head), F.lit(fixed.NO_CLUB))


def fill_signed_from(club: str | Column) -> Column:
    return F.coalesce(blank_to_null(club), F.lit(fixed.NO_ORIGIN))


def default_status(status: str | Column) -> Column:
    return F.coalesce(as_column(status), F.lit(fixed.DEFAULT_STATUS))


def clean_status(status: str | Column) -> Column:
    """Two states only: missing or a known available status, and everything else."""
    status = blank_to_null(status)
    unavailable = status.isNotNull() & ~F.lower(status).isin(*fixed.AVAILABLE_STATUSES)
    return F.when(unavailable, fixed.INJURED).otherwise(fixed.AVAILABLE)


def capitalize_first(text: str | Column) -> Column:
    """First character upper case, all others lower case; NULL for the empty string."""
    text = blank_to_null(text)
    rest = F.substr(text, F.lit(2))
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(rest))


def _or_as_it_was(shorter: Column, name: Column) -> Column:
    """A name of nothing but the suffix stays, so that such teams don't become one."""
    # Names ``shorter`` once, so that it is made once a row.
    return F.coalesce(blank_to_null(shorter), name)


def normalize_team_name(name: str | Column, mode: str = "token") -> Column:
    """Readable team name without the club suffix.

    ``token``      drops ``FC`` where it stands alone: ``AFC_X`` stays ``AFC X``
    ``substring``  drops the letters anywhere:         ``AFC_X`` becomes ``AX``
    """
    name = as_column(name)
    if mode == "token":
        alone = rf"(?<![^_\s]){fixed.CLUB_TOKEN}(?![^_\s])"
        return _or_as_it_was(F.trim(F.regexp_replace(name, rf"(?:{alone}|[_\s])+", " ")), name)
    if mode == "substring":
        shorter = reduce(
            lambda text, part: F.replace(text, F.lit(part), F.lit("")), fixed.CLUB_SUBSTRINGS, name
        )
        return _or_as_it_was(F.trim(F.translate(shorter, "_", " ")), name)
    raise ValueError(f"unknown mode {mode!r}: use 'token' or 'substring'")
