"""Raw squad documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.functions.cleaning import strip
from squadlake.functions.paths import (
    decode_path,
    file_name_of,
    season_from_path,
    team_from_file_name,
)
from squadlake.sources.schemas import CORRUPT, SQUAD
from squadlake.sources.sequences import BETWEEN, documents_in_sequence

DOCUMENT = f"{SQUAD}, {CORRUPT} string"
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
BYTE_ORDER_MARK = "﻿"
LAYOUTS = ("auto", "document", "lines", "sequence")

# Files up to this size are read as one text by one task, larger ones as a sequence of documents by many.
WHOLE_FILE = 256 << 20
END_MARK = "#end"


def split_documents(text: Column) -> Column:
    """The JSON texts of one value, of the elements of one array or of documents that
    follow one another on lines of their own; NULL if the text is anything else.

    A line break can't stand inside a JSON string, so a comma put where one stands
    between a closing and an opening brace changes no document.
    """

    def elements(json: Column) -> Column:
        # Spark gives the part of an array that it could read; the mark is there if it read all.
        listed = F.from_json(F.concat(F.lit("["), json, F.lit(f',"{END_MARK}"]')), "array<string>")
        whole = F.try_element_at(listed, F.lit(-1)) == END_MARK
        found = F.slice(listed, 1, F.size(listed) - 1)
        return F.when(
            whole,
            F.when(
                json.startswith("["), F.from_json(F.get(found, F.lit(0)), "array<string>")
            ).otherwise(found),
        )

    json = strip(text)
    found = F.coalesce(
        elements(json), elements(F.regexp_replace(json, r"\}([ \t\r]*\n\s*)\{", "},$1{"))
    )
    # Nothing to parse is no document either; a null element is one that can't be used.
    return F.when(F.size(found) > 0, F.transform(found, lambda x: F.coalesce(x, F.lit("null"))))


def _documents(text: Column) -> Column:
    """(document, NULL) of each document in ``text``; NULL if it is anything else."""
    none = F.lit(None).cast("string")
    return F.transform(
        split_documents(text), lambda x: F.struct(x.alias("document"), none.alias("unreadable"))
    )


def _documents_or_text(text: Column) -> Column:
    """(document, text that is none) of each document in ``text``, or of the text itself."""
    return F.coalesce(_documents(text), _unreadable(text))


def _unreadable(text: Column) -> Column:
    return F.array(F.struct(F.lit(None).cast("string").alias("document"), text.alias("unreadable")))


def _is_squad(line: Column) -> Column:
    """A line of its own as a document, and not a part of one that spans several lines."""
    root = F.from_json(line, "players string, updatedAt string")
    return split_documents(line).isNotNull() & root.isNotNull() & (
        root.getField("players").isNotNull() | root.getField("updatedAt").isNotNull()
    )


def _documents_of_file(text: Column, by_line: bool) -> Column:
    """All of a file's text, as documents; what can't be parsed is one of them too."""
    if not by_line:
        return _documents_or_text(text)
    lines = F.filter(F.split(text, "\n"), lambda line: strip(line) != "")
    each = F.flatten(F.transform(lines, _documents_or_text))
    return F.coalesce(_documents(text), F.when(F.exists(lines, _is_squad), each), _unreadable(text))


def _parsed(documents: DataFrame) -> DataFrame:
    """Documents with their path, parsed; the text of those that can't be is kept."""
    parsed = documents.select(
        "path", "found.*", F.from_json("found.document", DOCUMENT, PERMISSIVE).alias("squad")
    )
    unreadable = F.when(F.col("squad").isNull(), F.coalesce("unreadable", "document"))
    return parsed.select("squad.*", unreadable.alias("unreadable"), "path").select(
        "id",
        "players",
        "updatedAt",
        F.coalesce(CORRUPT, "unreadable").alias(CORRUPT),
        "path",
    )


def _of_seasons(files: DataFrame, seasons: Sequence[int | None] | None) -> DataFrame:
    """Judged by the path alone, so that other files are dropped when files are listed."""
    if seasons is None:
        return files
    season = season_from_path(decode_path("_metadata.file_path"))
    return files.where(reduce(or_, [season.eqNullSafe(one) for one in seasons], F.lit(False)))


def _has_large_files(spark: SparkSession, path: str, files: dict) -> bool:
    """Asks the listing alone."""
    listed = spark.read.format("binaryFile").options(**files).load(path).select("length")
    return not listed.where(F.col("length") > WHOLE_FILE).isEmpty()


def _scan_files(
    spark: SparkSession, path: str, files: dict, by_line: bool, seasons: Sequence[int | None] | None
) -> DataFrame:
    """Files as one text each, in one task each. They come as bytes, which is several
    times faster here than reading them as text."""
    content = _of_seasons(spark.read.format("binaryFile").options(**files).load(path), seasons)
    content = content.where(F.col("_metadata.file_size") <= WHOLE_FILE)
    text = F.ltrim(F.col("content").cast("string"), F.lit(BYTE_ORDER_MARK))
    return content.select(
        F.col("_metadata.file_path").alias("path"),
        F.explode(_documents_of_file(text, by_line)).alias("found"),
    )


def _scan_sequences(
    spark: SparkSession, path: str, files: dict, seasons: Sequence[int | None] | None, above: int = -1
) -> DataFrame:
    """Documents cut at their braces; what stands between them, or is left open, is judged as a text of its own."""

    def chosen(rows: DataFrame) -> DataFrame:
        return _of_seasons(rows if above < 0 else rows.where(F.col("_metadata.file_size") > above), seasons)

    texts = documents_in_sequence(spark, path, files, chosen)
    text = F.regexp_replace("text", rf"\A{BETWEEN}+", "")
    text = F.when(F.col("closed"), text).otherwise(F.regexp_replace(text, rf"{BETWEEN}+\z", ""))
    texts = texts.select("path", "closed", text.alias("text")).where(F.col("text") != "")
    none = F.lit(None).cast("string")
    before = strip(F.regexp_extract("text", r"(?s)\A[^{]*", 0))
    document = F.struct(
        F.substring("text", F.locate("{", F.col("text")), F.char_length("text")).alias("document"),
        none.alias("unreadable"),
    )
    beside = F.when(before != "", F.struct(none.alias("document"), before.alias("unreadable")))
    found = F.when(F.col("closed") & F.contains("text", F.lit("{")), F.array_compact(F.array(beside, document)))
    return texts.select("path", F.explode(found.otherwise(_documents_of_file(F.col("text"), True))).alias("found"))


def _scan_lines(
    spark: SparkSession, path: str, files: dict, seasons: Sequence[int | None] | None
) -> DataFrame:
    lines = _of_seasons(spark.read.options(**files).text(path), seasons)
    text = F.ltrim(F.col("value"), F.lit(BYTE_ORDER_MARK))
    return lines.where(strip(text) != "").select(
        F.col("_metadata.file_path").alias("path"),
        F.explode(_documents_or_text(text)).alias("found"),
    )


def scan_squad_json(
    spark: SparkSession,
    path: str,
    layout: str = "auto",
    glob: str = "*.json",
    seasons: Sequence[int | None] | None = None,
) -> DataFrame:
    """Squad documents below ``path`` with ``team``, ``season`` and ``source_file``.

    ``document``  a file is one document, an array of them, or several one after another
    ``auto``      the same; a file that isn't, is read line by line if a line is a document
    ``lines``     every line is a document or an array; large files are split at lines
    ``sequence``  documents one after another or in an array, wherever lines end; large files are split anywhere

    What a text is, parsing decides. The schema is given, so nothing is read twice to
    infer it. Text that can't be parsed stays as a row, in ``_corrupt_record``: a file or line
    with anything beside its documents, or two of them on a line, is such a text as a whole. In a sequence
    documents are told by their braces, and only the text beside them is such a row; ``auto`` and ``document`` read files above
    WHOLE_FILE so, see ``sequences``.
    ``seasons`` leaves files of other seasons unopened.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}: use one of {', '.join(LAYOUTS)}")
    files = {"recursiveFileLookup": True, "pathGlobFilter": glob}
    if layout == "lines":
        documents = _scan_lines(spark, path, files, seasons)
    elif layout == "sequence":
        documents = _scan_sequences(spark, path, files, seasons)
    else:
        documents = _scan_files(spark, path, files, layout == "auto", seasons)
        if _has_large_files(spark, path, files):
            documents = documents.unionByName(_scan_sequences(spark, path, files, seasons, WHOLE_FILE))
    return (
        _parsed(documents)
        .withColumn("source_file", decode_path("path"))
        .withColumns(
            {
                "team": team_from_file_name(file_name_of("source_file")),
                "season": season_from_path("source_file"),
            }
        )
        .drop("path")
    )
