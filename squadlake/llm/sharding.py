"""Documents in shards of near equal size, equal texts together: minimax contiguous partition."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squadlake.llm.common import kept, whole

ROW_BYTES = 16
BUCKETS = 65_536
CELL_ROWS = 4_096


def minimax_cuts(sizes: list[int], parts: int) -> list[int]:
    """Ends of ``parts`` contiguous ranges whose largest sum is the smallest possible.

    The capacity is found by binary search, with a greedy pass to check it. The cuts then stay
    within it and lie as near to equal shares as it allows; ranges may be empty.
    """
    prefix = [0, *accumulate(sizes)]
    total, count = prefix[-1], len(sizes)

    def reach(start: int, capacity: int) -> int:
        return bisect_right(prefix, prefix[start] + capacity, start) - 1

    def feasible(capacity: int) -> bool:
        position = 0
        for _ in range(parts):
            position = reach(position, capacity)
            if position == count:
                return True
        return False

    low, high = max([0, *sizes, -(-total // parts)]), total
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    # latest[j]: the first position from which j ranges of this capacity reach the end.
    latest = [count]
    for _ in range(parts - 1):
        latest.append(bisect_left(prefix, prefix[latest[-1]] - low))
    ends, start = [], 0
    for left in range(parts, 0, -1):
        share = prefix[start] + (total - prefix[start]) / left
        near = bisect_left(prefix, share, start)
        if near > start and near <= count and share - prefix[near - 1] < prefix[near] - share:
            near -= 1
        start = min(max(near, latest[left - 1], start), reach(start, low))
        ends.append(start)
    return ends


def plan_shards(buckets: list[tuple[int, int]], shards: int) -> tuple[dict[int, int], list[int]]:
    """(shard of each bucket that needs one to itself, first bucket of shards 1, 2, ... of the rest).

    A bucket over the fair share of what is left can only be alone; the others share what
    remains of the shards, so that one large group doesn't set the size of all.
    """
    rest, alone = sorted(buckets), []
    total = sum(size for _, size in rest)
    for bucket, size in sorted(buckets, key=lambda x: (-x[1], x[0])):
        if len(rest) < 2 or size * (shards - len(alone)) <= total:
            break
        alone.append(bucket)
        total -= size
        rest.remove((bucket, size))
    ends = minimax_cuts([size for _, size in rest], shards - len(alone))
    cuts = [rest[end][0] if end < len(rest) else BUCKETS for end in ends[:-1]]
    return {b: shards - 1 - i for i, b in enumerate(alone)}, cuts


def shard_documents(
    docs: DataFrame, shards: int = 40, buckets: int = BUCKETS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``doc_id, text, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the text's bytes in UTF-8 plus ROW_BYTES. Equal texts fall in one of ``buckets``
    by their hash, and a bucket is the atomic group: shards are contiguous ranges of buckets, so
    that only the buckets' totals, bounded in number, reach the driver. A shard then differs
    from the optimum over single texts by less than one bucket. Slots number the rows of a shard
    from 0 without gaps; they are counted in cells of about ``cell_rows`` rows, so no
    task orders a whole shard or a whole group of copies.

    A null text counts as an empty one, a null id is kept, repeated rows are rows of
    their own, an empty table gives an empty result, other columns are ignored.
    """
    text = whole(F.col("text"))
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(buckets)).alias("bucket"),
    )
    totals = kept(
        rows.groupBy("bucket").agg(F.sum("size").alias("total"), F.count("*").alias("rows"))
    )
    alone, cuts = plan_shards(
        [(row["bucket"], row["total"]) for row in totals.select("bucket", "total").toLocalIterator()],
        shards,
    )
    cells = totals.select("bucket", F.ceil(F.col("rows") / cell_rows).alias("cells"))
    dealt = (
        # At most `buckets` rows of two numbers.
        rows.join(F.broadcast(cells), "bucket")
        .withColumn("shard", _shard(F.col("bucket"), alone, cuts))
        # By content, so that both passes and every retry deal alike.
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "bucket"), F.col("cells")))
    )
    in_order = (
        Window.partitionBy("shard").orderBy("bucket", "cell").rowsBetween(Window.unboundedPreceding, 0)
    )
    dealt = dealt.select("doc_id", "text", "size", "text_crc32", "shard", "bucket", "cell")
    counts = (
        dealt.groupBy("shard", "bucket", "cell")
        .agg(F.count("*").alias("rows"))
        .withColumn("before", F.sum("rows").over(in_order) - F.col("rows"))
        .select("bucket", "cell", "before")
    )
    in_cell = Window.partitionBy("bucket", "cell").orderBy("doc_id", "text_crc32")
    return (
        dealt.withColumn("number", F.row_number().over(in_cell))
        .join(counts, ["bucket", "cell"])
        .select(
            "doc_id", "text", "size", "text_crc32", "shard",
            (F.col("before") + F.col("number") - 1).alias("slot"),
        )
    )


def _shard(bucket: Column, alone: dict[int, int], cuts: list[int]) -> Column:
    passed = reduce(lambda total, cut: total + (bucket >= cut).cast("int"), cuts, F.lit(0))
    return reduce(
        lambda otherwise, item: F.when(bucket == item[0], item[1]).otherwise(otherwise),
        alone.items(),
        passed,
    ).cast("int")


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """What the registered query returns: no text, and the law the shards obey."""
    return shard_documents(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
