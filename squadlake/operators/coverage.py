"""Which entities appear in which periods, and which periods they miss.

The period is a whole number (a season year). Periods of an entity are bits: 64 neighbouring ones share a word,
which is a number of its own, so that a task sends one row for an entity and word whatever number of rows and periods
it saw, sub-totals merge by OR, and what is missing is one AND NOT. Words nobody uses don't exist: periods may lie any
distance apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Periods of a word, as a power of two.
WORD_BITS = 6
WORDS, USED, MISSING = "__words", "__used", "__missing"


def list_seasons(df: DataFrame, period: str = "season") -> DataFrame:
    return df.select(period).where(F.col(period).isNotNull()).distinct()


def _word(period: Column) -> Column:
    return F.shiftright(period.cast("bigint"), WORD_BITS).alias("word")


def _bits(period: Column) -> Column:
    """Aggregate: the periods of one word, as bits."""
    place = period.cast("bigint").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place)).alias("bits")


def period_words(df: DataFrame, entity: str, period: str) -> DataFrame:
    """``word, bits`` of every entity: sub-totals that merge by OR."""
    known = df.select(entity, period).where(F.col(period).isNotNull())
    return known.groupBy(entity, _word(F.col(period))).agg(_bits(F.col(period)))


def _listed() -> Column:
    """Aggregate: an entity's words, in order."""
    return F.array_sort(F.collect_list(F.struct("word", "bits"))).alias(WORDS)


def _periods(words: Column, kind: DataType) -> Column:
    """The periods of some words, in order."""

    def of_word(word: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1)), lambda i: F.getbit(word["bits"], i) == 1
        )
        return F.transform(places, lambda i: (F.call_function("shiftleft", word["word"], F.lit(WORD_BITS)) + i).cast(kind))

    return F.flatten(F.transform(words, of_word))


def _number(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda n, word: n + F.bit_count(word["bits"]))


def _with_missing(present: DataFrame) -> DataFrame:
    """Adds the words of the periods that an entity lacks and others have.

    The words in use come from the very shuffle their caller reads: they ask for its other columns too.
    """
    others = {f"__{name}": name for name in present.columns if name != WORDS}
    each = (
        present.select("*", F.explode(WORDS).alias("__word"))
        .groupBy(F.col("__word.word").alias("word"))
        .agg(F.bit_or("__word.bits").alias("bits"), *[F.max(n).alias(alias) for alias, n in others.items()])
    )
    used = each.agg(F.struct(_listed(), *[F.max(alias).alias(alias) for alias in others])).scalar()
    own = F.map_from_entries(WORDS)
    return present.withColumn(USED, used.getField(WORDS)).withColumn(
        MISSING,
        F.transform(
            USED,
            lambda word: F.struct(
                word["word"].alias("word"),
                word["bits"]
                .bitwiseAND(F.bitwise_not(F.coalesce(F.try_element_at(own, word["word"]), F.lit(0).cast("bigint"))))
                .alias("bits"),
            ),
        ),
    )


def _by_entity(df: DataFrame, entity: str, period: str) -> DataFrame:
    return period_words(df, entity, period).groupBy(entity).agg(_listed())


def seasons_by_team(
    df: DataFrame, entity: str = "team", period: str = "season", alias: str = "seasons"
) -> DataFrame:
    """Sorted periods of every entity."""
    periods = _periods(F.col(WORDS), df.schema[period].dataType)
    return _by_entity(df, entity, period).select(entity, periods.alias(alias))


def coverage_gaps(df: DataFrame, entity: str = "team", period: str = "season") -> DataFrame:
    """(entity, period) pairs missing from the table, for periods some entity has; nothing is joined."""
    present = _with_missing(_by_entity(df, entity, period))
    absent = _periods(F.col(MISSING), df.schema[period].dataType)
    return present.select(entity, F.explode(absent).alias(period))


def _file_words(df: DataFrame, entity: str, period: str, file: str) -> DataFrame:
    """Per entity: files, and words of periods. A file belongs to one period."""
    return (
        df.select(entity, period, file)
        .distinct()
        .groupBy(entity, _word(F.col(period)))
        .agg(F.count(file).alias("__files"), _bits(F.col(period)))
        .groupBy(entity)
        .agg(
            F.sum("__files").alias("files"),
            # Rows without a period count as files alone.
            F.array_sort(
                F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "bits")))
            ).alias(WORDS),
        )
    )


def coverage_report(
    df: DataFrame, entity: str = "team", period: str = "season", file: str = "source_file"
) -> DataFrame:
    """Per entity: files, periods present and periods missing.

    Rows shrink to files, to words and to entities, each step reducing before its shuffle.
    """
    present, kind = _with_missing(_file_words(df, entity, period, file)), df.schema[period].dataType
    return present.select(
        entity,
        "files",
        _periods(F.col(WORDS), kind).alias(f"{period}s_present"),
        _periods(F.col(MISSING), kind).alias(f"{period}s_missing"),
    )


def run_totals(
    df: DataFrame, entity: str = "team", period: str = "season", file: str = "source_file"
) -> DataFrame:
    """One row for the whole table: entities, periods, files, pairs present and pairs missing.

    Pairs are counted as bits; no list of periods is made.
    """
    present = _with_missing(_file_words(df, entity, period, file))
    counted = present.select(
        "files", _number(F.col(WORDS)).alias("present"), _number(F.col(MISSING)).alias("missing")
    )
    return counted.agg(
        F.count(F.lit(1)).alias(f"{entity}s"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
    )
