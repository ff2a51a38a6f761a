"""Exact top-k inner products by bit-sliced indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squadlake.llm.common import findable

SCALE = 64
#: Rows of a block: so many that a bitmap of them is worth a call of its own. Queries of a group.
ROWS, QUERIES = 65_536, 1_024


class BitSlices:
    """Bitmaps over the rows of one block: slice b of an attribute marks the rows with bit b set.

    An attribute is held less its smallest value, so that no slice has a sign.
    """

    def __init__(self, values: np.ndarray):
        self.rows = len(values)
        self.lowest = values.min(axis=0)
        shifted = (values - self.lowest).astype(np.uint64)
        self.widths = [int(x).bit_length() for x in shifted.max(axis=0)]
        self.words = -(-self.rows // 64)
        self.all = _bitmap(np.ones(self.rows, bool), self.words)
        self.slices = [
            [_bitmap((shifted[:, d] >> np.uint64(b)) & np.uint64(1) > 0, self.words) for b in range(width)]
            for d, width in enumerate(self.widths)
        ]
        # A negative weight adds the complement: -w*x = w*(top - x) - w*top.
        self.unset = [[self.all & ~s for s in each] for each in self.slices]

    def score(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's inner product with ``query``, less the constant also returned.

        Bitmaps of one weight are added three at a time: their exclusive or stays, their
        majority carries to the next weight.
        """
        weights: dict[int, list[np.ndarray]] = {}
        base = int(sum(int(q) * int(low) for q, low in zip(query, self.lowest)))
        for d, q in enumerate(int(x) for x in query):
            for j, digit in _signed_digits(q):
                if digit < 0:
                    base -= ((1 << self.widths[d]) - 1) << j
                for b, bits in enumerate(self.slices[d] if digit > 0 else self.unset[d]):
                    weights.setdefault(b + j, []).append(bits)
        total, at = [], 0
        while weights:
            waiting = weights.pop(at, [])
            carried = weights.setdefault(at + 1, []) if len(waiting) > 1 else []
            while len(waiting) > 2:
                a, b, c = waiting.pop(), waiting.pop(), waiting.pop()
                either = a ^ b
                waiting.append(either ^ c)
                carried.append((a & b) | (either & c))
            if len(waiting) == 2:
                a, b = waiting
                waiting = [a ^ b]
                carried.append(a & b)
            total.append(waiting[0] if waiting else np.zeros(self.words, np.uint64))
            at += 1
        return total, base

    def top(self, slices: list[np.ndarray], k: int) -> np.ndarray:
        """Rows that may be among the k highest: all above the boundary, all on it."""
        sure, open_ = np.zeros(self.words, np.uint64), self.all
        for bits in reversed(slices):
            with_bit = sure | (open_ & bits)
            n = int(np.bitwise_count(with_bit).sum())
            if n > k:
                open_ = open_ & bits
            else:
                sure = with_bit
                open_ = open_ & ~bits
                if n == k:
                    open_ = np.zeros(self.words, np.uint64)
                    break
        return np.flatnonzero(np.unpackbits((sure | open_).view(np.uint8), bitorder="little")[: self.rows])


def _signed_digits(number: int) -> Iterator[tuple[int, int]]:
    """Places and signs of the fewest powers of two that add up to ``number``: no two are neighbours."""
    place = 0
    while number:
        if number & 1:
            sign = 2 - (number & 3)
            yield place, sign
            number -= sign
        number >>= 1
        place += 1


def _bitmap(flags: np.ndarray, words: int) -> np.ndarray:
    packed = np.packbits(flags, bitorder="little")
    return np.pad(packed, (0, words * 8 - len(packed))).view(np.uint64)


def block_search(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """The best k rows of one block for each query of one group."""
    if rows.empty or queries.empty:
        return
    rows = rows.sort_values("vec_id")
    ids, values = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy())
    place = dict(zip(rows["row"].to_list(), range(len(rows))))
    index = BitSlices(values)
    for row, query, vector in zip(queries["row"].to_list(), queries["vec_id"].to_list(), queries["v"]):
        slices, base = index.score(vector)
        # The query's own row may be among the highest, so that one more is asked for.
        own = place.get(row, -1)
        found = index.top(slices, k + (own >= 0))
        found = found[found != own]
        score = np.full(len(found), base, np.int64)
        for weight, s in enumerate(slices):
            bits = (s[found >> 6] >> (found & 63).astype(np.uint64)) & np.uint64(1)
            score += bits.astype(np.int64) << weight
        # Rows on the boundary are told apart by their id; the sort is stable and ids ascend.
        best = np.argsort(-score, kind="stable")[:k]
        yield pd.DataFrame({"row": row, "query_id": query, "vec_id": ids[found[best]], "score": score[best]})


FOUND = ("row", "query_id", "vec_id", "score")


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: floor(64 * x) of each component; rows with nothing to compare are left out.

    Left out are null ids, null and empty vectors, and vectors with a null or non-finite component.
    """
    usable = F.expr(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(double(x)) < double('Infinity'))"
    )
    return vectors.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & usable
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.expr(f"transform(embedding, x -> floor({SCALE} * double(x)))").alias("v"),
    )


def top_inner_products(vectors: DataFrame, every: int = 20, k: int = 20, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each query, exactly.

    Queries are the rows whose id is divisible by ``every``. Rows are dealt to blocks of about
    ``rows``, each with an index of its own; queries go in groups of about ``queries`` to every
    block, so that no task sees more than one block and one group. Each pair gives at most k rows
    a query. The query's own row is no candidate; ties go to the smaller id; vectors of
    another length than the query's are not compared. Scores must fit a long. Rows with a null id
    or an unusable vector take no part, rows that repeat an id or all of another are candidates and
    queries each, other columns are ignored, an empty table gives an empty result.
    """
    # Numbered as they are read: the same rows get the same numbers wherever they are read again.
    ints = quantised(findable(vectors)).withColumns(
        {"part": F.size("v"), "row": F.monotonically_increasing_id()}
    )
    count = ints.count()
    blocks, groups = -(-count // rows) or 1, -(-count // (every * queries)) or 1
    # By number, which is even also if most rows are equal.
    candidates = ints.withColumn("block", F.pmod("row", F.lit(blocks))).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    asked = (
        ints.where(F.col("vec_id") % every == 0)
        .withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(block_search(left, right, k))
        return pd.concat(found) if found else pd.DataFrame({n: [] for n in FOUND}, dtype="int64")

    keys = ["part", "block", "group"]
    found = (
        candidates.groupBy(*keys).cogroup(asked.groupBy(*keys))
        .applyInPandas(search, ", ".join(f"{name} long" for name in FOUND))
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SEARCH_SQL = f"""
with ints as materialized (
    select row_number() over () as key, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null and len(embedding) > 0 and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.key, q.vec_id as query_id, c.vec_id,
           cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
    from ints q join ints c on q.key <> c.key and len(q.v) = len(c.v)
    where q.vec_id % 20 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
    select *, row_number() over (partition by key order by score desc, vec_id) as rank from scored
) where rank <= 20
"""
