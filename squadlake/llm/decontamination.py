"""Benchmark passages in documents: a broadcast set of word windows, built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import ascii_lower, kept, small_side, whole

WINDOW = 13
#: Digits, lower-case letters and everything that isn't ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows that are broadcast at most, about 100 bytes each; more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: A document is contaminated if this share of its words, as 1 in so many, is hit.
SHARE = 20


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(whole(text)), F.lit(WORD), F.lit(0))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``passage, length, items``: each distinct window and the sorted ids of its items.

    An item of fewer words than ``window`` is one window, one without words is none.
    """
    spoken = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        words(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    return (
        spoken.select(
            "item_id",
            F.least(F.size("words"), F.lit(window)).alias("length"),
            F.explode(_passages(F.col("words"), F.least(F.size("words"), F.lit(window)))).alias("run"),
        )
        .select("item_id", "length", "run.passage")
        .groupBy("passage", "length")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )


def _passages(spoken: Column, length: Column | int) -> Column:
    """Every run of ``length`` words, as its first word's number and its text; none if there are fewer words."""
    length = F.lit(length) if isinstance(length, int) else length
    starts = F.when(F.size(spoken) >= length, F.sequence(F.lit(1), F.size(spoken) - length + 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.array_join(F.slice(spoken, at, length), " ").alias("passage"))
    )


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``text_key, spans, items`` of the texts in which windows of ``items`` occur.

    ``text_key`` is the SHA-256 of the text, so equal texts have one row; ``spans`` are the
    first word and the length of every occurrence, in order; ``items`` the ids found, sorted.
    Windows are compared as whole strings, so that a hash alone never decides.
    """
    windows = kept(benchmark_windows(items, window))
    sizes = windows.groupBy("length").count().collect()  # at most `window` rows
    if not sizes:
        sizes = [(window, 0)]
    if sum(count for _, count in sizes) <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)
    spoken = docs.select(text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("words"))
    runs = F.flatten(F.array(*(_passages(F.col("words"), n) for n, _ in sizes)))
    found = (
        spoken.select("text_key", F.explode(runs).alias("run"))
        .select("text_key", "run.at", "run.passage")
        .join(windows, "passage")
    )
    # Copies of a text find the same, once each; they meet before anything is gathered.
    return (
        found.groupBy("text_key", "at", "length")
        .agg(F.first("items").alias("items"))
        .groupBy("text_key")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", "length"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(whole(text), 256))


def words_hit(spans: Column) -> Column:
    """Words inside any of the spans, which are in the order of their first word."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("hit")),
        lambda so_far, span: F.struct(
            F.greatest(so_far["upto"], span["at"] + span["length"]).alias("upto"),
            (
                so_far["hit"]
                + F.greatest(F.lit(0), span["at"] + span["length"] - F.greatest(so_far["upto"], span["at"]))
            ).alias("hit"),
        ),
        lambda so_far: so_far["hit"],
    )


def mark_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, carried: list[str] | None = None
) -> DataFrame:
    """``row`` and ``contamination`` (n_words, n_hit, items, contaminated), both structs.

    ``row`` has all columns of ``docs``, or those ``carried``: only these move with the marks.
    A document is contaminated if any word is hit and the words hit are at least one in
    SHARE. A null text has no words; items with a null id count under the id ``null``; repeated
    rows are marked alike; a table without rows, on either side, marks nothing.
    """
    found = find_passages(docs, items, window).select(
        F.col("text_key").alias("_text_key"), words_hit(F.col("spans")).alias("_hit"), F.col("items").alias("_items")
    )
    marked = docs.select(
        F.struct(*(docs[c] for c in carried or docs.columns)).alias("row"),
        text_key(docs["text"]).alias("_text_key"),
        F.size(words(docs["text"])).cast("long").alias("n_words"),
    ).join(found, "_text_key", "left")
    hit = F.coalesce("_hit", F.lit(0).cast("long"))
    return marked.select(
        "row",
        F.struct(
            "n_words",
            hit.alias("n_hit"),
            F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
            ((hit > 0) & (SHARE * hit >= F.col("n_words"))).alias("contaminated"),
        ).alias("contamination"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, all their columns as they were.

    Only ids and hashes of texts are marked and compared; where the contaminated are few enough to be
    broadcast, no text moves.
    """
    named = docs.select(F.col("doc_id"), F.col("text"), F.xxhash64(whole(F.col("text"))).alias("text_hash"))
    marked = mark_contaminated(named, items, window, carried=["doc_id", "text_hash"])
    bad = marked.where(F.col("contamination.contaminated")).select(
        F.col("row.doc_id").alias("_bad_id"), F.col("row.text_hash").alias("_bad_hash")
    )
    bad = small_side(kept(bad.distinct()))
    same = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(whole(docs["text"])) == bad["_bad_hash"])
    return docs.join(bad, same, "left_anti")


def decontamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    marked = mark_contaminated(docs.select("doc_id", "text"), items, carried=["doc_id"])
    found = F.col("contamination")
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        found["contaminated"].alias("contaminated"),
    )


DECONTAMINATION_SQL = f"""
with doc_words as (
    select row_number() over () as rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as words
    from documents
),
item_words as (
    select coalesce(cast(item_id as varchar), 'null') as item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as words
    from benchmark
),
windows as (
    select distinct item_id, least(len(words), {WINDOW}) as length,
           array_to_string(words[s:s + least(len(words), {WINDOW}) - 1], ' ') as passage
    from (select *, unnest(range(1, len(words) - least(len(words), {WINDOW}) + 2)) as s
          from item_words where len(words) > 0)
),
lengths as (select distinct length from windows),
starts as (
    select rid, words, length, unnest(range(1, len(words) - length + 2)) as s
    from doc_words join lengths on len(words) >= length
),
hits as (
    select rid, s, length, item_id
    from (select rid, s, length, array_to_string(words[s:s + length - 1], ' ') as passage from starts)
    join windows using (length, passage)
),
covered as (
    select rid, count(distinct w) as n_hit
    from (select rid, unnest(range(s, s + length)) as w from hits) group by rid
),
named as (
    select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
    from (select distinct rid, item_id from hits) group by rid
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and {SHARE} * coalesce(n_hit, 0) >= len(words) as contaminated
from doc_words left join covered using (rid) left join named using (rid)
"""
