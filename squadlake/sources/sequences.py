"""Documents one after another, or in one array, in files of any size: many tasks read one file.

A file is read as pieces that end at a closing brace, which Spark's text source cuts in ranges of bytes, each by a task
of its own. Whether a brace opens or closes a document depends on everything before it: on whether that leaves a
string open, and on how many braces are. Both are prefix sums. Quotes (an escaped one is none) are counted in
every range, braces under both assumptions about how the range begins; a sum over the ranges of a file, a few numbers
each, tells which of the two holds and how deep the range begins. A document ends where the depth is nought
outside strings. Pieces of a range are put together where they are; only what reaches over an edge is moved again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CLOSE = "}"
#: What may stand between documents.
BETWEEN = r"[\s,\[\]\x{FEFF}]"

RANGE = ("path", "start")


def _braces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit("{"), F.lit("")))


def _pieces(
    spark: SparkSession, path: str, files: dict, chosen: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Pieces in their order, with the quotes left open and the depth gained if they begin outside or inside a string."""
    pieces = chosen(spark.read.options(lineSep=CLOSE, **files).text(path)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece"),
    )
    # An escape never reaches over a brace: no quote can follow the backslash before it.
    bare = F.when(F.contains("piece", F.lit("\\")), F.regexp_replace("piece", r"(?s)\\.", "")).otherwise(F.col("piece"))
    pieces = pieces.withColumn("turns", F.split(bare, '"', -1))
    outside, inside = (
        _braces(F.array_join(F.filter("turns", lambda _, i: i % 2 == side), "")) for side in (0, 1)
    )
    odd = (F.size("turns") - 1) % 2
    return pieces.withColumns(
        {"odd": odd, "deeper_0": outside - (1 - odd), "deeper_1": inside - odd}
    ).drop("turns")


def _before(*keys: str, by: tuple[str, ...]) -> Window:
    return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(column: Column, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _ranges(pieces: DataFrame) -> DataFrame:
    """Each range's beginning: in a string or not, how deep, and whether its last piece lacks its brace."""
    totals = pieces.groupBy(*RANGE).agg(
        F.sum("odd").alias("odd"),
        F.sum("from_0").alias("from_0"),
        F.sum("from_1").alias("from_1"),
        F.sum(F.octet_length("piece") + 1).alias("bytes"),
        F.max("at").alias("last"),
        F.max("file_bytes").alias("file_bytes"),
    )
    earlier = _before("path", by=("start",))
    file = Window.partitionBy("path")
    # Every piece was counted with its brace; a byte order mark, three bytes, may have been dropped.
    over = F.sum("bytes").over(file) - F.col("file_bytes")
    return (
        totals.withColumn("begins", _sum_before(F.col("odd"), earlier) % 2)
        .withColumn("deeper", F.when(F.col("begins") == 0, F.col("from_0")).otherwise(F.col("from_1")))
        .select(
            *RANGE,
            "begins",
            _sum_before(F.col("deeper"), earlier).alias("depth"),
            F.when(
                over.isin(1, -2) & (F.col("start") == F.max("start").over(file)), F.col("last")
            ).alias("unclosed"),
        )
    )


def _joined(parts: Column) -> Column:
    """Texts of (place, text) pairs, in order."""
    return F.array_join(F.transform(F.array_sort(parts), lambda part: part["text"]), "")


def documents_in_sequence(
    spark: SparkSession,
    path: str,
    files: dict,
    chosen: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``path, text, closed``: the documents of all files below ``path``, and any text beside them.

    ``text`` runs from the end of the document before to the end of its own, so it may begin with what stands
    between the two; ``closed`` is false for what follows a file's last document. Braces that don't pair shift
    the ends after them in that file, but no text is lost. ``chosen`` picks files by their metadata. A document
    is put together in one task, whatever number of ranges it takes, and must fit there; files must not be compressed.
    """
    order = _before(*RANGE, by=("at",))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = _pieces(spark, path, files, chosen)
    pieces = pieces.withColumn("within", _sum_before(F.col("odd"), order) % 2)
    even = F.col("within") == 0
    pieces = pieces.withColumns(
        {
            "from_0": F.when(even, F.col("deeper_0")).otherwise(F.col("deeper_1")),
            "from_1": F.when(even, F.col("deeper_1")).otherwise(F.col("deeper_0")),
        }
    )
    placed = pieces.join(_ranges(pieces), [*RANGE])
    gained = F.when(F.col("begins") == 0, F.sum("from_0").over(upto)).otherwise(F.sum("from_1").over(upto))
    closed = F.coalesce(F.col("unclosed") != F.col("at"), F.lit(True))
    ends = closed & ((F.col("begins") + F.col("within") + F.col("odd")) % 2 == 0) & (F.col("depth") + gained == 0)
    text = F.concat("piece", F.when(closed, CLOSE).otherwise(""))
    # The first of a range that begins within a document, and the last of one that ends so, go on elsewhere.
    opens = (F.col("begins") == 0) & (F.col("depth") == 0)
    groups = (
        placed.select(*RANGE, "at", text.alias("text"), ends.alias("ends"), opens.alias("opens"))
        .withColumn("number", _sum_before(F.col("ends").cast("int"), order))
        .groupBy(*RANGE, "number")
        .agg(
            _joined(F.collect_list(F.struct("at", "text"))).alias("text"),
            F.bool_or("ends").alias("ends"),
            (F.bool_and("opens") | (F.col("number") > 0)).alias("opens"),
        )
    )
    whole = groups.where("opens and ends").select("path", "text", F.lit(True).alias("closed"))
    pieced = (
        groups.where("not (opens and ends)")
        .withColumn("document", _sum_before(F.col("ends").cast("int"), _before("path", by=("start", "number"))))
        .groupBy("path", "document")
        .agg(
            _joined(F.collect_list(F.struct("start", "number", "text"))).alias("text"),
            F.bool_or("ends").alias("closed"),
        )
        .drop("document")
    )
    return whole.unionByName(pieced)
