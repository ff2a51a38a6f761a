"""Near-duplicate documents: SimHash fingerprints, linked by BK-trees over bit distance."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import LOWER, UPPER, findable, kept, small_side, whole
from squadlake.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fingerprints in one tree at most.
TREE = 1_024
#: Shingles whose hashes are held at once, and fingerprints that search at once.
CHUNK, SEARCHERS = 1 << 18, 2_048

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, some at a time. Words lie between ASCII white space."""
    words = text.translate(_LOWER).split()
    if not words:
        return
    said = b" ".join(words)
    begins = np.zeros(len(words), np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(lengths[:-1] + 1, out=begins[1:])
    last = min(size, len(words)) - 1
    ends = (begins + lengths)[last:]
    begins = begins[: len(ends)]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), CHUNK):
        pairs = zip(begins[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        yield np.array([digest(said[b:e], SEED) for b, e in pairs], np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 without words. As a signed long."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
        total += len(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` of every row; a null text is an empty one."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes(), size) for t in batch["data"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(found, pa.int64())],
                ["doc_id", "text_hash", "fingerprint"],
            )

    text = whole(F.col("text"))
    narrow = findable(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.encode(text, "utf-8").alias("data"),
    )
    return narrow.mapInArrow(compute, "doc_id long, text_hash long, fingerprint long")


class Forest:
    """BK-trees, one for each shard: a child's key is its distance to its parent.

    All trees are built and searched together, level by level.
    """

    def __init__(self, prints: np.ndarray, shards: np.ndarray):
        """``shards`` ascends; prints within a shard differ."""
        self.prints = prints
        first = np.flatnonzero(np.append(True, shards[1:] != shards[:-1]))
        self.root = first[np.searchsorted(first, np.arange(len(prints)), "right") - 1]
        parent, edge = np.full(len(prints), -1), np.zeros(len(prints), np.int64)
        left = np.flatnonzero(self.root != np.arange(len(prints)))
        at = self.root[left]
        while len(left):
            apart = np.bitwise_count(prints[left] ^ prints[at]).astype(np.int64)
            _, index, inverse = np.unique(at * 128 + apart, return_index=True, return_inverse=True)
            parent[left[index]], edge[left[index]] = at[index], apart[index]
            rest = np.ones(len(left), bool)
            rest[index] = False
            at, left = left[index][inverse][rest], left[rest]
        key = parent * 128 + edge
        self.children = np.argsort(key, kind="stable")
        self.keys = key[self.children]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different nodes of a tree at most ``radius`` bits apart.

        From a node at distance d only edges from d - radius to d + radius can lead to more.
        """
        for start in range(0, len(self.prints), SEARCHERS):
            seeker = np.arange(start, min(start + SEARCHERS, len(self.prints)))
            node = self.root[seeker]
            while len(seeker):
                apart = np.bitwise_count(self.prints[seeker] ^ self.prints[node]).astype(np.int64)
                near = (apart <= radius) & (seeker != node)
                yield seeker[near], node[near]
                low = np.searchsorted(self.keys, node * 128 + np.maximum(apart - radius, 1))
                high = np.searchsorted(self.keys, node * 128 + apart + radius, "right")
                size = high - low
                ends = np.cumsum(size)
                which = np.repeat(low - ends + size, size) + np.arange(ends[-1])
                seeker, node = np.repeat(seeker, size), self.children[which]


def linked_roots(prints: np.ndarray, shards: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the position of the first of its shard that links reach."""
    label = np.arange(len(prints))
    pairs = list(Forest(prints, shards).within(radius))
    a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        label = label[label]
        if (label == before).all():
            return label


def _link_shards(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links from each fingerprint to the first it reaches in its shard; rows come sorted by shard."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> pa.RecordBatch:
        shards = np.cumsum(np.append(False, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
        label = linked_roots(rows[:, 2].view(np.uint64), shards, radius)
        moved = label != np.arange(len(label))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[moved, 2]), pa.array(rows[label[moved], 2])], ["a", "b"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.column_stack([batch[c].to_numpy() for c in ("mask", "value", "fingerprint")]))
        rows = np.concatenate(held)
        # The last shard may go on in the next batch.
        whole_shards = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
        cut = whole_shards[-1] + 1 if len(whole_shards) else 0
        if cut:
            yield links(rows[:cut])
        held = [np.ascontiguousarray(rows[cut:])]
    if held and len(held[0]):
        yield links(held[0])


def thirds(mask: int) -> list[int]:
    """``mask`` with one of three parts of its unset bits set."""
    free = [b for b in range(64) if not mask >> b & 1]
    ends = [len(free) * i // 3 for i in range(4)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(ends, ends[1:])]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _refine(members: DataFrame, masks: list[int]) -> DataFrame:
    """Members of the shards that fix one more third of the bits that ``masks`` leave free."""
    finer = F.lit(None).cast("array<long>")
    for mask in masks:
        parts = F.array(*(F.lit(_signed(m)).cast("long") for m in thirds(mask)))
        finer = F.when(F.col("mask") == _signed(mask), parts).otherwise(finer)
    return (
        members.select("fingerprint", F.explode(finer).alias("mask"))
        .distinct()
        .withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
    )


def link_fingerprints(prints: DataFrame, radius: int = DISTANCE, tree: int = TREE) -> DataFrame:
    """``a, b``: links that connect whatever of the distinct ``fingerprint`` s is connected.

    Of three parts of the bits, two fingerprints at most two bits apart agree in one, so each part's
    value names a shard in which to look. A shard over ``tree`` fingerprints is split the same
    way by the bits it leaves free, again and again: with each step two thirds
    of them stay free, and ``n`` free bits allow ``2**n`` fingerprints, so after five steps none can be over
    1,024. Each shard's tree is built and searched where the shard is, and gives one link for a fingerprint
    at most, not all pairs.
    """
    if radius > 2:
        raise ValueError("three parts find distances up to 2")
    members, masks = findable(prints).select("fingerprint").distinct().withColumn("mask", F.lit(0).cast("long")), [0]
    links = None
    while True:
        members = kept(_refine(members, masks))
        masks = sorted({finer for mask in masks for finer in thirds(mask)})
        sizes = members.groupBy("mask", "value").count().where(F.col("count") > 1)
        dealt = members.join(sizes, ["mask", "value"])
        small = dealt.where(F.col("count") <= tree).select("mask", "value", "fingerprint")
        found = (
            small.repartition("mask", "value")
            .sortWithinPartitions("mask", "value", "fingerprint")
            .mapInArrow(lambda batches: _link_shards(batches, radius), "a long, b long")
        )
        links = found if links is None else links.unionByName(found)
        large = dealt.where(F.col("count") > tree).select("fingerprint", "mask")
        if all(bin(mask).count("1") >= 54 for mask in masks) or large.isEmpty():
            return links
        members = large


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = DISTANCE) -> DataFrame:
    """``doc_id, text_hash, fingerprint, root, component_id`` of every row.

    ``root`` is one fingerprint of the component, ``component_id`` its smallest doc_id. Null ids
    are never the smallest (null, if all are); null and empty texts have the
    fingerprint 0, which links like any other; repeated rows belong to one component; an empty
    table gives an empty result; other columns are ignored.
    """
    rows = kept(with_fingerprints(docs, size))
    prints = kept(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(link_fingerprints(prints, radius))
    named = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.select("fingerprint", "root").join(ids, "root"), "fingerprint")


def one_of_each(docs: DataFrame, size: int = SHINGLE, radius: int = DISTANCE) -> DataFrame:
    """One document of each component, all its columns: the one of the smallest id.

    Null ids come last; of equal ids the text with the smallest hash stays, of repeated rows one.
    """
    marked = kept(near_duplicates(docs, size, radius))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = marked.groupBy("root").agg(F.min(order).alias("best"))
    dropped = marked.join(best, "root").where(~order.eqNullSafe(F.col("best"))).select("doc_id", "text_hash").distinct()
    again = (
        marked.groupBy("root", "doc_id", "text_hash").count().where(F.col("count") > 1).select("doc_id", "text_hash")
    )
    # An id and a hash of each: few enough to be broadcast, no text moves for them.
    rest = _where(docs, small_side(kept(dropped)), "left_anti")
    if again.isEmpty():
        return rest
    again = kept(again)
    once = _where(rest, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return _where(rest, again, "left_anti").unionByName(once)


def _where(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    ids = ids.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = docs["doc_id"].cast("long").eqNullSafe(ids["_id"]) & (F.xxhash64(whole(docs["text"])) == ids["_hash"])
    return docs.join(ids, same, how)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def simhash_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")
