"""Row validity, quarantine and run statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def reject_reason(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks, joined by commas; NULL for a valid row.

    A rule holds only when it is true, as in a filter: NULL breaks it.
    """
    broken = [F.when(valid, None).otherwise(name) for name, valid in rules.items()]
    return F.nullif(F.concat_ws(",", *broken), F.lit(""))


def row_counts(rules: Mapping[str, Column]) -> dict[str, Column]:
    """Aggregates: rows, rows without and with a broken rule, and rows that break each of them."""
    rejected = reject_reason(rules).isNotNull()
    return {
        "rows_in": F.count(F.lit(1)),
        "rows_out": F.count_if(~rejected),
        "rejected": F.count_if(rejected),
    } | {f"broken_{name}": F.count_if(~F.coalesce(valid, F.lit(False))) for name, valid in rules.items()}


def observed(
    aggregates: Mapping[str, Column],
) -> tuple[Callable[[DataFrame], DataFrame] | None, Callable[[], dict[str, int]]]:
    """A step that computes aggregates while rows pass it, and a call that gives them once the rows are written.

    Nothing is read for it. Applied behind a job's last shuffle, a task that fails and runs again, or runs
    twice, counts once: only the attempt whose result the job took adds its rows.
    """
    if not aggregates:
        return None, dict
    seen = Observation()
    columns = [column.alias(name) for name, column in aggregates.items()]
    return lambda df: df.observe(seen, *columns), lambda: dict(seen.get)


def valid_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    for valid in rules.values():
        df = df.where(valid)
    return df


def quarantine(
    df: DataFrame, rules: Mapping[str, Column], reason: str = "reject_reason"
) -> DataFrame:
    """The rows ``valid_rows`` leaves out, with the reason."""
    return df.withColumn(reason, reject_reason(rules)).where(F.col(reason).isNotNull())


def quality_report(
    df: DataFrame,
    layer: str,
    keys: Sequence[str],
    rules: Mapping[str, Column],
    file: str | None = None,
    array: str | None = None,
) -> DataFrame:
    """Rows in, out and rejected for every key; for documents also extra files and
    documents that are valid but hold nothing.

    ``file`` is counted distinct through a first aggregate on (keys, file), so a
    key with very many files is spread over tasks.
    """
    files = file_counts(df, keys, rules, file, array)
    return quality_of_files(files, layer, keys, file or NO_FILE)


NO_FILE = "__file"


def file_counts(
    df: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Column],
    file: str | None = None,
    array: str | None = None,
) -> DataFrame:
    """``rows, rejected, empty`` of every file of every key: all that the reports of a layer need."""
    rejected = reject_reason(rules).isNotNull()
    filled = F.coalesce(F.size(array) > 0, F.lit(False)) if array else F.lit(True)
    marked = df.select(
        *keys,
        (F.col(file) if file else F.lit(None).cast("string")).alias(file or NO_FILE),
        rejected.alias("__rejected"),
        (~rejected & ~filled).alias("__empty"),
    )
    return marked.groupBy(*keys, file or NO_FILE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("__rejected").alias("rejected"),
        F.count_if("__empty").alias("empty"),
    )


def quality_of_files(files: DataFrame, layer: str, keys: Sequence[str], file: str) -> DataFrame:
    """``quality_report`` from the rows of ``file_counts``."""
    extra_files = F.greatest(F.count(file) - 1, F.lit(0))
    return files.groupBy(*keys).agg(
        F.sum("rows").alias("rows_in"),
        F.sum(F.col("rows") - F.col("rejected")).alias("rows_out"),
        F.sum("rejected").alias("rejected"),
        extra_files.cast("bigint").alias("duplicate_files"),
        F.sum("empty").alias("empty_squads"),
    ).select(F.lit(layer).alias("layer"), "*")
