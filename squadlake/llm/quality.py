"""Text quality: perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from squadlake.llm.common import findable, free_name, is_held_out, kept, small_side, whole
from squadlake.llm.token_files import mapped, place
from squadlake.session import shared_folder

#: Symbols are the 16-bit units of UTF-16: every character is itself, one beyond the basic plane is two. Four
#: of them are one long, so n-grams are compared exactly, and there are as many as the trusted text has.
UNIT, ORDER = 16, 4
UNITS = 1 << UNIT
#: Of the trusted documents one in so many sets the limits; the model is trained on the others,
#: as it finds what it was trained on less perplexing than anything else.
SET_APART = 4
#: Quantiles of the trusted documents' log-perplexity in each language between which a document passes, and what they
#: are moved outwards by, over the root of how many there were: few documents say little about a quantile.
LOWEST, PASSING, UNSURE = 0.001, 0.995, 0.75
#: Quantiles are read from counts of log-perplexity in steps of this size.
STEP = 0.001
#: Symbols looked at together, and different n-grams a task holds before it gives their counts away.
TOGETHER, HELD = 1 << 20, 1 << 20


def units_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.int64)


def n_grams(units: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The n-gram that ends at each place from ``start`` on; nothing, as unit 0, stands before a text."""
    stop = len(units) if stop is None else stop
    before = units[max(start - ORDER + 1, 0) : start]
    padded = np.concatenate([np.zeros(ORDER - 1 - len(before), np.int64), before, units[start:stop]])
    keys = np.zeros(stop - start, np.int64)
    for i in range(ORDER):
        keys = (keys << UNIT) | padded[i : i + stop - start]
    return keys


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of its text, n-gram) of every place, at most TOGETHER at a time, whatever the length of a text."""
    numbers, grams, held = [], [], 0
    for number, text in enumerate(texts):
        units = units_of(text or "")
        for start in range(0, len(units), TOGETHER):
            grams.append(n_grams(units, start, min(start + TOGETHER, len(units))))
            numbers.append(np.full(len(grams[-1]), number))
            held += len(grams[-1])
            if held >= TOGETHER:
                yield np.concatenate(numbers), np.concatenate(grams)
                numbers, grams, held = [], [], 0
    if held:
        yield np.concatenate(numbers), np.concatenate(grams)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task, given away whenever it holds too many different n-grams."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def given(part: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1])], ["gram", "n"])

    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for batch in batches:
        for _, grams in _pieces(batch["text"].to_pylist()):
            held = merged([held, np.unique(grams, return_counts=True)])
            if len(held[0]) > HELD:
                yield given(held)
                held = (held[0][:0], held[1][:0])
    yield given(held)


def gram_counts(texts: DataFrame) -> DataFrame:
    """``gram, n``: counts of each task, added up by gram."""
    return (
        findable(texts).select(whole(F.col("text")).alias("text"))
        .mapInArrow(_count, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )


class Discounts(NamedTuple):
    one: float
    two: float
    more: float


def discounts(grams: DataFrame) -> Discounts:
    """Modified Kneser-Ney discounts from how many grams were seen once, twice, three and four times."""
    ones, twos, threes, fours = grams.agg(
        *(F.sum((F.col("n") == i).cast("long")) for i in range(1, 5))
    ).first()
    ones, twos, threes, fours = (max(1, x or 0) for x in (ones, twos, threes, fours))
    y = ones / (ones + 2 * twos)
    found = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    # With next to no text the estimates can leave their range.
    return Discounts(*(min(max(d, 0.1), most) for d, most in zip(found, (1.0, 2.0, 3.0))))


class Shard(NamedTuple):
    """Numbers by key, ascending, in two flat files."""

    first: int
    last: int
    rows: int
    name: str


class Numbers(NamedTuple):
    """A table of one number for each key, in shards that Spark's tasks wrote and tasks map when they look keys up."""

    folder: str
    shards: tuple[Shard, ...]

    def of(self, keys: np.ndarray, otherwise: float) -> np.ndarray:
        """The numbers of ascending ``keys``; only the shards that may hold one are touched."""
        out = np.full(len(keys), otherwise)
        for shard in self.shards:
            begin, end = np.searchsorted(keys, shard.first, "left"), np.searchsorted(keys, shard.last, "right")
            if begin == end:
                continue
            held, numbers = _shard(f"{self.folder}/{shard.name}", shard.rows)
            at = np.searchsorted(held, keys[begin:end])
            found = held[np.minimum(at, shard.rows - 1)] == keys[begin:end]
            out[begin:end][found] = numbers[at[found]]
        return out


@cache
def _shard(path: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    return mapped(f"{path}.keys", "<i8")(0, rows), mapped(f"{path}.numbers", "<f8")(0, rows)


def stored_numbers(rows: DataFrame, folder: str) -> Numbers:
    """Write (key, number) rows, sorted by range over all tasks. One row for each shard reaches the driver.

    An attempt writes files of its own name, and only those of attempts that Spark took are listed.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        system.create_dir(root, recursive=True)
        name, first, last, count = uuid.uuid4().hex, None, None, 0
        with (
            system.open_output_stream(f"{root}/{name}.keys") as keys,
            system.open_output_stream(f"{root}/{name}.numbers") as numbers,
        ):
            for batch in batches:
                held = batch["key"].to_numpy().astype("<i8")
                keys.write(held.tobytes())
                numbers.write(batch["number"].to_numpy().astype("<f8").tobytes())
                if len(held):
                    first = held[0] if first is None else first
                    last, count = held[-1], count + len(held)
        if count:
            row = [[int(first)], [int(last)], [count], [name]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), list(Shard._fields))

    ordered = findable(rows).repartitionByRange("key").sortWithinPartitions("key")
    shards = kept(ordered.mapInArrow(write, "first long, last long, rows long, name string"))
    return Numbers(folder, tuple(sorted(Shard(*row) for row in shards.collect())))


class Model(NamedTuple):
    """Of each order, lowest first: probabilities of seen n-grams, and the weight that a context leaves to the order below."""

    seen: tuple[Numbers, ...]
    left: tuple[Numbers, ...]

    def log_p(self, keys: np.ndarray) -> np.ndarray:
        """The log-probability of each n-gram's last symbol, after those before it; every different one is looked up once."""
        different, where = np.unique(keys, return_inverse=True)
        p = np.full(len(different), 1 / UNITS)
        for n, (seen, left) in enumerate(zip(self.seen, self.left), 1):
            grams = _last(different, n)
            order = np.argsort(grams, kind="stable")
            own = np.empty(len(grams))
            own[order] = seen.of(grams[order], np.nan)
            contexts = _last(grams.view(np.uint64) >> np.uint64(UNIT), n - 1)
            order = np.argsort(contexts, kind="stable")
            rest = np.empty(len(grams))
            rest[order] = left.of(contexts[order], 1.0)
            p = np.where(np.isnan(own), rest * p, own)
        return np.log(p)[where]


def _last(keys: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` symbols of each key."""
    keys = keys.view(np.int64)
    return keys if n == ORDER else keys & ((1 << UNIT * n) - 1)


def train(texts: DataFrame) -> Model:
    """The model of ``texts``: every order's counts and contexts are sharded tables, joined by gram in Spark.

    Counts of the highest order are occurrences, of the lower ones the different symbols that
    stood before. Nothing of it but four counts an order and the list of shards reaches the driver.
    """
    folder = f"{shared_folder(texts.sparkSession)}/quality-{uuid.uuid4().hex}"
    orders = [kept(gram_counts(texts))]
    for n in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << UNIT * n) - 1)).alias("gram")
        orders.append(kept(orders[-1].groupBy(shorter).agg(F.count("*").alias("n"))))
    below: DataFrame | None = None
    seen_numbers, left_numbers = [], []
    for n, seen in enumerate(reversed(orders), 1):
        d = discounts(seen)
        off = F.when(F.col("n") == 1, d.one).when(F.col("n") == 2, d.two).otherwise(d.more)
        context = F.shiftrightunsigned("gram", UNIT).alias("context")
        contexts = kept(
            seen.groupBy(context)
            .agg(F.sum("n").alias("total"), F.sum(off).alias("off"))
            .select("context", "total", (F.col("off") / F.col("total")).alias("left"))
        )
        rated = (
            seen.withColumn("context", context)
            .join(contexts, "context")
            .withColumn("own", F.greatest(F.col("n") - off, F.lit(0.0)) / F.col("total"))
        )
        if below is None:
            rated = rated.withColumn("p", F.col("own") + F.col("left") / UNITS)
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << UNIT * (n - 1)) - 1))
            lower = below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rated = rated.withColumn("suffix", suffix).join(lower, "suffix").withColumn(
                "p", F.col("own") + F.col("left") * F.col("lower")
            )
        below = kept(rated.select("gram", "p"))
        for rows, numbers, kind in (
            (below.toDF("key", "number"), seen_numbers, "seen"),
            (contexts.select(F.col("context").alias("key"), F.col("left").alias("number")), left_numbers, "left"),
        ):
            numbers.append(stored_numbers(rows, f"{folder}/{kind}-{n}"))
    return Model(tuple(seen_numbers), tuple(left_numbers))


def with_perplexity(docs: DataFrame, model: Model, name: str, carried: list[str] | None = None) -> DataFrame:
    """The columns of ``docs``, or those ``carried``, and the perplexity of each whole text.

    It is null for an empty or null text.
    """
    carried = carried or docs.columns
    kept_at = [docs.columns.index(c) for c in carried]
    at = docs.columns.index("text")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, symbols = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for numbers, grams in _pieces(batch.column(at).to_pylist()):
                total += np.bincount(numbers, model.log_p(grams), batch.num_rows)
                symbols += np.bincount(numbers, minlength=batch.num_rows)
            found = np.exp(-total / np.maximum(symbols, 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept_at), pa.array(found, mask=symbols == 0)], [*carried, name]
            )

    fields = [docs.schema.fields[i] for i in kept_at]
    return findable(docs).mapInArrow(score, StructType([*fields, StructField(name, DoubleType())]))


def language_limits(scored: DataFrame, passing: float = PASSING, lowest: float = LOWEST) -> DataFrame:
    """``lang, low, high``: the limits of log-perplexity in each language, and under null in all.

    Values are counted in steps of STEP before they meet, so a language's window holds no more
    rows than there are steps, however many documents it has.
    """
    steps = scored.where("perplexity > 0").select(
        whole(F.col("lang")).alias("lang"), F.floor(F.log("perplexity") / STEP).alias("step")
    )
    counted = kept(steps.groupBy("lang", "step").count())
    everywhere = counted.groupBy(F.lit(None).cast("string").alias("lang"), "step").agg(F.sum("count").alias("count"))
    ordered = Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy("lang")
    return (
        counted.unionByName(everywhere)
        .withColumn("upto", F.sum("count").over(ordered))
        .withColumn("all", F.sum("count").over(total))
        .groupBy("lang")
        .agg(
            (
                F.min(F.when(F.col("upto") > lowest * F.col("all"), F.col("step"))) * STEP
                - UNSURE / F.sqrt(F.max("all"))
            ).alias("low"),
            (
                (F.min(F.when(F.col("upto") >= passing * F.col("all"), F.col("step"))) + 1) * STEP
                + UNSURE / F.sqrt(F.max("all"))
            ).alias("high"),
        )
    )


def trusted_documents(docs: DataFrame, labels: DataFrame, held_out: bool = False) -> DataFrame:
    """The documents with a label of quality 1, less the held-out third; with ``held_out``, that third."""
    ids = labels.where((F.col("quality") == 1) & (is_held_out() == held_out)).select("doc_id").distinct()
    return docs.select("doc_id", "text", "lang").join(small_side(ids), "doc_id", "left_semi")


def judge(
    docs: DataFrame, labels: DataFrame, carried: list[str] | None = None
) -> tuple[DataFrame, str, Column]:
    """(``docs`` with a perplexity and a flag, the name of the perplexity, the flag's column).

    Of ``docs`` all columns stay, or those ``carried``, ``lang`` among them.

    The flag says whether a document is kept: its log-perplexity lies between the limits of its
    language, or of all where no trusted text set apart is in its language. A null or
    empty text is not kept. Without any trusted text nothing else is rejected. Null ids and
    languages, repeated rows and further columns stay as they are.
    """
    trusted = trusted_documents(docs, labels)
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(SET_APART)) == 0
    model = train(trusted.where(~apart))
    limits = kept(language_limits(with_perplexity(trusted.where(apart), model, "perplexity", ["lang"])))
    name = free_name(docs, "perplexity")
    low, high, key, flag = (free_name(docs, n) for n in ("low", "high", "limit_lang", "kept"))
    scored = with_perplexity(docs, model, name, carried)
    everywhere = limits.where(F.col("lang").isNull()).first()
    own = limits.where(F.col("lang").isNotNull()).toDF(key, low, high)
    marked = scored.join(small_side(own), whole(scored["lang"]) == F.col(key), "left")
    inside = F.log(F.col(name)).between(
        F.coalesce(F.col(low), F.lit(everywhere["low"] if everywhere else -1e9)),
        F.coalesce(F.col(high), F.lit(everywhere["high"] if everywhere else 1e9)),
    )
    return marked.withColumn(flag, F.coalesce(inside, F.lit(False))).drop(key, low, high), name, F.col(flag)


def trusted_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, all their columns."""
    judged, _, flag = judge(docs, labels)
    return judged.where(flag).select(*(F.col(f"`{c}`") for c in docs.columns))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    judged, name, flag = judge(docs.select("doc_id", "text", "lang"), labels, ["doc_id", "lang"])
    return judged.select("doc_id", "lang", F.col(name).alias("perplexity"), flag.alias("kept"))
