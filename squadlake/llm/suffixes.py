"""Repeated passages: sparse suffix arrays over content-selected positions, matches extended both ways."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squadlake.llm.common import findable, kept, small_side, whole

#: A passage counts from this many words on.
LEAST = 50
#: Words hashed together at a position. Of any LEAST words, one position at least is selected.
GRAM = 16
STRETCH = LEAST - GRAM + 1
#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15
POSITIONS = "row_key long, doc_id long, position int, gram long, around long, left int, right int"


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class WordHashes:
    """64-bit hashes of words, each computed once in a task while there is room."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _prefix_sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of hash times inverse power, and powers: with them any stretch's hash is two lookups."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(n + 1, np.uint64(BASE)))
        inverse = np.cumprod(np.full(n, np.uint64(_inverse(BASE))))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * inverse)]), powers


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _stretches(sums: np.ndarray, powers: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed((sums[end] - sums[begin]) * powers[begin])


def select_positions(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, their gram's hash): the least gram of every STRETCH, leftmost of equal ones.

    The choice depends on the words alone, so a passage has the same positions wherever
    it stands. Where the same gram repeats at once, as in a repeated word, one in
    STRETCH and the last are kept.
    """
    if len(hashes) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums, powers = _prefix_sums(hashes)
    begin = np.arange(len(hashes) - GRAM + 1)
    grams = _stretches(sums, powers, begin, begin + GRAM)
    chosen = []
    for at in range(0, len(grams) - STRETCH + 1, 1 << 16):
        part = np.lib.stride_tricks.sliding_window_view(grams[at : at + (1 << 16) + STRETCH - 1], STRETCH)
        chosen.append(np.unique(np.argmin(part, axis=1) + np.arange(len(part)) + at))
    positions = np.unique(np.concatenate(chosen))
    goes_on = np.append(False, (np.diff(positions) == 1) & (grams[positions[1:]] == grams[positions[:-1]]))
    index = np.arange(len(positions))
    rank = index - np.maximum.accumulate(np.where(goes_on, 0, index))
    positions = positions[(rank % STRETCH == 0) | np.append(~goes_on[1:], True)]
    return positions, grams[positions]


def _positions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = WordHashes()
    names = [f.split()[0] for f in POSITIONS.split(", ")]
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in names]
        ids, sizes = batch["doc_id"], []
        keys = batch["row_key"].to_numpy()
        for n, text in enumerate(batch["text"]):
            hashes = hashed.of(text.as_py().split())
            at, grams = select_positions(hashes)
            sizes.append(len(at))
            if not len(at):
                continue
            sums, powers = _prefix_sums(hashes)
            begin, end = np.maximum(at - LEAST, 0), np.minimum(at + LEAST, len(hashes))
            around = _stretches(sums, powers, begin, end)
            found = (np.full(len(at), keys[n]), None, at, grams, around, at - begin, end - at)
            for column, values in zip(columns, found):
                if values is not None:
                    column.append(values)
        taken = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        if not len(taken):
            continue
        out = []
        for name, column in zip(names, columns):
            if name == "doc_id":
                out.append(ids.take(taken))
            else:
                kind = pa.int32() if name in ("position", "left", "right") else pa.int64()
                values = np.concatenate(column)
                out.append(pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, kind))
        yield pa.RecordBatch.from_arrays(out, names)


def positions(docs: DataFrame) -> DataFrame:
    """POSITIONS of every text: a gram's hash, and a hash of up to LEAST words to either side of its start."""
    return _narrow(docs).mapInArrow(_positions, POSITIONS)


def _narrow(docs: DataFrame) -> DataFrame:
    text = whole(F.col("text"))
    return findable(docs).select(F.xxhash64("doc_id", text).alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words about each wanted position: those before it from the nearest on, and those from it on."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch["text"], batch["wanted"]):
            words = text.as_py().split()
            for w in wanted.as_py():
                at = w["position"]
                rows.append(
                    {
                        "gram": w["gram"], "around": w["around"],
                        "suffix": " ".join(words[at : at + w["right"]]),
                        "before": " ".join(words[at - w["left"] : at][::-1]),
                    }
                )
        yield pa.RecordBatch.from_pylist(rows, _CONTEXT)


_CONTEXT = pa.schema([("gram", pa.int64()), ("around", pa.int64()), ("suffix", pa.string()), ("before", pa.string())])
NEIGHBOURS = "gram long, around long, suffix string, before string, edge int, matched_left int, matched_right int"


def common_words(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _matched(a: dict, b: dict) -> tuple[int, int]:
    """How far two suffixes agree to the left and to the right; nothing if it makes no passage."""
    if a["gram"] != b["gram"]:
        return 0, 0
    right = common_words(a["suffix"].split(" "), b["suffix"].split(" "))
    left = common_words(a["before"].split(" "), b["before"].split(" ")) if a["before"] and b["before"] else 0
    return (left, right) if left + right >= LEAST else (0, 0)


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sorted suffix with what it shares with the one before and the one after.

    The first and the last of a task carry its number, to be compared over its border.
    """
    task = TaskContext.get().partitionId()
    held: dict | None = None
    first = True
    out: list[dict] = []

    def record(row: dict, edge: int | None) -> None:
        for left, right in sorted(row["met"]) or [(0, 0)]:
            out.append(
                {k: row[k] for k in ("gram", "around")}
                | {"suffix": row["suffix"] if edge is not None else None, "before": row["before"] if edge is not None else None}
                | {"edge": edge, "matched_left": left, "matched_right": right}
            )

    for batch in batches:
        for row in batch.to_pylist():
            row["met"] = set()
            if held is not None:
                both = _matched(held, row)
                if both != (0, 0):
                    held["met"].add(both)
                    row["met"].add(both)
                record(held, 2 * task if first else None)
                first = False
            held = row
        yield pa.RecordBatch.from_pylist(out, _NEIGHBOUR)
        out = []
    if held is not None:
        if first:
            record(held, 2 * task)
        record(held, 2 * task + 1)
    yield pa.RecordBatch.from_pylist(out, _NEIGHBOUR)


_NEIGHBOUR = pa.schema(
    [*_CONTEXT, ("edge", pa.int32()), ("matched_left", pa.int32()), ("matched_right", pa.int32())]
)


def _over_borders(edges: DataFrame) -> DataFrame:
    """Matches between the last suffix of a task and the first of the next: two rows a task."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for row in batch.to_pylist():
                # A task of one suffix gives it under both its edges.
                other = held is not None and held["edge"] // 2 != row["edge"] // 2
                if other and (both := _matched(held, row)) != (0, 0):
                    out += [{"gram": r["gram"], "around": r["around"], "matched_left": both[0], "matched_right": both[1]} for r in (held, row)]
                held = row
        yield pa.RecordBatch.from_pylist(out, pa.schema([_NEIGHBOUR.field(i) for i in (0, 1, 5, 6)]))

    in_order = edges.select("gram", "around", "suffix", "before", "edge").distinct().repartition(1).sortWithinPartitions("edge")
    return in_order.mapInArrow(compare, "gram long, around long, matched_left int, matched_right int")


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every stretch of LEAST words about a position that holds its gram, as a hash."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            before = row["before"].split(" ")[::-1] if row["before"] else []
            words = [*before, *row["suffix"].split(" ")]
            for at in range(max(0, len(before) - (LEAST - GRAM)), min(len(before), len(words) - LEAST) + 1):
                rows.append(
                    {
                        "gram": row["gram"], "around": row["around"], "offset": len(before) - at,
                        "window": xxhash.xxh3_64_intdigest(" ".join(words[at : at + LEAST])) - (1 << 63),
                    }
                )
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("gram", pa.int64()), ("around", pa.int64()), ("offset", pa.int32()), ("window", pa.int64())]))


def matches(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``row_key, doc_id, begin, end``: stretches of at least LEAST words that stand elsewhere too.

    1. A position whose gram no other has is dropped, after a count of grams alone; of equal ones
       with equal words around, counting is enough: the match reaches as far as is looked.
    2. One of each that differs in the words around gives its suffix. Suffixes are sorted over all
       tasks by range, so that a common passage is split between tasks, and compared
       with their neighbours, then extended to the left.
    3. A neighbour need not be the one with which the left side agrees too. Where a gram has more
       than two suffixes and one could match further than it does so far, all of them are looked up
       by all stretches of LEAST words that hold the gram.
    Each position looks LEAST words to either side; along a longer passage lie so many
    positions that their matches cover it.
    """
    all_positions = positions(docs)
    repeated = all_positions.groupBy("gram").count().where(F.col("count") > 1).select("gram")
    found = kept(all_positions.join(repeated, "gram"))
    kinds = found.groupBy("gram", "around").agg(F.count("*").alias("rows"), F.min_by(F.struct("row_key", "position", "left", "right"), F.struct("row_key", "position")).alias("one"))
    grams = kinds.groupBy("gram").agg(F.count("*").alias("kinds"))
    kinds = kept(kinds.join(grams.where(F.col("kinds") > 1), "gram", "left").where((F.col("rows") > 1) | F.col("kinds").isNotNull()))
    alike = kinds.where(F.col("rows") > 1).select("gram", "around", F.lit(LEAST).alias("matched_left"), F.lit(LEAST).alias("matched_right"))
    wanted = (
        kinds.where(F.col("kinds") > 1)
        .groupBy(F.col("one.row_key").alias("row_key"))
        .agg(F.collect_list(F.struct("gram", "around", "one.position", "one.left", "one.right")).alias("wanted"))
    )
    # Only their texts move, if there are few enough to say so beforehand.
    wanted = kept(wanted)
    those = _narrow(docs).join(small_side(wanted.select("row_key")), "row_key", "left_semi")
    texts = those.select("row_key", "text").join(wanted, "row_key").select("text", "wanted")
    contexts = kept(texts.mapInArrow(_contexts, "gram long, around long, suffix string, before string").dropDuplicates(["gram", "around"]))
    ordered = contexts.repartitionByRange("gram", "suffix", "before").sortWithinPartitions("gram", "suffix", "before")
    compared = kept(ordered.mapInArrow(_neighbours, NEIGHBOURS))
    near = compared.select("gram", "around", "matched_left", "matched_right").unionByName(
        _over_borders(compared.where(F.col("edge").isNotNull()))
    )
    near = kept(near.where(F.col("matched_right") > 0).distinct())
    # Of two suffixes each has met the other. Of more, one is left out only where its matches
    # reach as far as stretches that hold the gram can.
    several = contexts.groupBy("gram").count().where(F.col("count") > 2).select("gram")
    reached = alike.unionByName(near).groupBy("gram", "around").agg(
        F.max("matched_left").alias("to_left"), F.max("matched_right").alias("to_right")
    )
    size = lambda c: F.when(F.col(c) == "", 0).otherwise(F.size(F.split(c, " ")))
    short = contexts.join(reached, ["gram", "around"], "left").where(
        (F.coalesce("to_left", F.lit(-1)) < F.least(size("before"), F.lit(LEAST - GRAM)))
        | (F.coalesce("to_right", F.lit(-1)) < size("suffix"))
    )
    near_ones = contexts.join(short.select("gram").distinct().join(several, "gram", "left_semi"), "gram", "left_semi")
    stretches = kept(near_ones.mapInArrow(_windows, "gram long, around long, offset int, window long"))
    # By gram as well: one stretch can hold several.
    same = ["gram", "offset", "window"]
    often = stretches.groupBy(*same).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    further = stretches.join(often.select(*same), same).select(
        "gram", "around", F.col("offset").alias("matched_left"), (LEAST - F.col("offset")).alias("matched_right")
    )
    reach = alike.unionByName(near).unionByName(further).distinct()
    return found.join(reach, ["gram", "around"]).select(
        "row_key",
        "doc_id",
        (F.col("position") - F.least("left", "matched_left")).alias("begin"),
        (F.col("position") + F.least("right", "matched_right")).alias("end"),
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, begin, end``: in each document the stretches of words that stand elsewhere too.

    Words lie between white space and count from 0, ``end`` is exclusive; stretches that touch
    are one. A run of one word that repeats only by overlapping itself may be left out. Documents without a repeated passage have no row, and texts of fewer than
    LEAST words can have none. A null text is empty, a null id is kept, a repeated row repeats all of
    its text, an empty table gives an empty result, other columns are ignored.
    """
    found = matches(docs).distinct()
    so_far = Window.partitionBy("row_key", "doc_id").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("row_key", "doc_id").orderBy("begin", "end")
    return (
        found.withColumn("opens", F.coalesce(F.col("begin") > F.max("end").over(so_far), F.lit(True)))
        .withColumn("passage", F.sum(F.col("opens").cast("int")).over(in_order))
        .groupBy("row_key", "doc_id", "passage")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .select("doc_id", "begin", "end")
    )
