"""Vectors clustered around centroids, each finding its nearest by the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import findable, kept

SCALE = 64
DIMENSIONS, CENTROIDS, ROUNDS, SEED = 64, 16, 3, 1
#: Up to this size of components, squared distances of a few thousand dimensions fit 64 bits.
NATIVE = 1 << 24

LONGEST = (1 << 63) - 1


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id, v``: floor(64 * x) of vectors with ``dimensions`` components, none null or non-finite."""
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(double(x)) < double('Infinity'))"
    return vectors.where((F.size("embedding") == dimensions) & F.expr(finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.expr(f"transform(embedding, x -> floor({SCALE} * double(x)))").alias("v"),
    )


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``values`` the nearest centroid, the smaller number on ties, and its squared distance.

    Every dimension lists the centroids by their component. From a vector's own value each list is
    walked outwards, one centroid a step in every dimension; a centroid met for the first time gets its
    exact distance. One not met yet lies at least as far off in every dimension as the last one met there:
    once the sum of those squared gaps strictly exceeds the best distance, the vector is done.
    """
    count, dims = values.shape
    number = len(centroids)
    far = 1 << 200 if values.dtype == object else LONGEST
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    every = np.arange(dims)
    right = np.stack([np.searchsorted(lists[:, d], values[:, d]) for d in every], axis=1)
    left = right - 1
    best, cluster = np.full(count, far, values.dtype), np.full(count, number)
    met = np.zeros((count, number), bool)
    live = np.arange(count)
    while len(live):
        x, low, high = values[live], left[live], right[live]
        below = x - lists[np.maximum(low, 0), every]
        above = lists[np.minimum(high, number - 1), every] - x
        down = (low >= 0) & ((high >= number) | (below <= above))
        gap = np.where(down, below, above)
        new = np.zeros((len(live), number), bool)
        np.put_along_axis(new, order[np.where(down, low, high), every], True, axis=1)
        new &= ~met[live]
        met[live] |= new
        row, found = np.nonzero(new)
        distance = np.full((len(live), number), far, values.dtype)
        apart = x[row] - centroids[found]
        distance[row, found] = (apart * apart).sum(axis=1)
        nearer = np.argmin(distance, axis=1)
        least = distance[np.arange(len(live)), nearer]
        better = (least < best[live]) | ((least == best[live]) & (nearer < cluster[live]))
        best[live[better]], cluster[live[better]] = least[better], nearer[better]
        left[live] -= down
        right[live] += ~down
        # With all centroids met there is nothing left to find either.
        done = ((gap * gap).sum(axis=1) > best[live]) | met[live].all(axis=1)
        live = live[~done]
    return cluster, best


def _blocks(batches: Iterable[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
    """Each batch with its vectors, clusters and distances. Components too large for 64 bits are Python integers."""
    large = len(centroids) and max(abs(int(centroids.min())), abs(int(centroids.max()))) > NATIVE
    for batch in batches:
        if batch.num_rows:
            flat = batch["v"].flatten().to_numpy()
            values = flat.reshape(batch.num_rows, -1)
            if large or flat.max(initial=0) > NATIVE or flat.min(initial=0) < -NATIVE:
                values, at = values.astype(object), centroids.astype(object)
            else:
                at = centroids.astype(np.int64)
            yield batch, values, *nearest(values, at)


def assign(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of each vector of ``quantised``; distances stop at the largest long."""

    def map_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in _blocks(batches, centroids):
            distance = np.minimum(distance, LONGEST).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return ints.mapInArrow(map_batches, "vec_id long, cluster int, distance long")


def _sums(centroids: np.ndarray) -> Callable:
    """Adds up the vectors of each cluster in a task: one row for each cluster and dimension, however many vectors."""

    def map_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(len(centroids), np.int64)
        totals = np.zeros(centroids.shape, object)
        for _, values, cluster, _ in _blocks(batches, centroids):
            rows += np.bincount(cluster, minlength=len(centroids))
            for number in np.unique(cluster):
                totals[number] += values[cluster == number].sum(axis=0)
        filled = np.flatnonzero(rows)
        dims = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(filled, dims).astype(np.int32)),
                pa.array(np.tile(np.arange(dims), len(filled)).astype(np.int32)),
                pa.array([int(t) for t in totals[filled].ravel()], pa.decimal128(38)),
                pa.array(np.repeat(rows[filled], dims)),
            ],
            names=["cluster", "dimension", "total", "vectors"],
        )

    return map_batches


def first_centroids(ints: DataFrame, number: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``number`` vectors whose ids hash lowest with ``seed``, lowest first; fewer if there are fewer.

    Rows of one id are ordered by their vectors. A null id is hashed as no digits.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = ints.select(drawn.alias("drawn"), "v").orderBy("drawn", "v").limit(number).collect()
    return np.array([row["v"] for row in rows], np.int64)


def improved(ints: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid with vectors moves to the exact floor of their mean. Only centroids reach the driver."""
    sums = (
        ints.mapInArrow(_sums(centroids), "cluster int, dimension int, total decimal(38, 0), vectors long")
        .groupBy("cluster", "dimension")
        .agg(F.sum("total").alias("total"), F.sum("vectors").alias("vectors"))
    )
    moved = centroids.copy()
    for row in sums.collect():
        moved[row["cluster"], row["dimension"]] = int(row["total"]) // row["vectors"]
    return moved


CLUSTERED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def centroid_clusters(
    vectors: DataFrame, number: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``, one row for each usable vector.

    Vectors of another length than ``dimensions``, null ones and those with a null or non-finite
    component take no part. Components are floor(64 * x), so all arithmetic is exact. A round moves each centroid
    to the mean of its vectors; after ``rounds`` of them vectors are assigned once more. Centroids, at most
    ``number`` times ``dimensions`` integers, are all that the driver holds or that tasks are sent; tasks add their
    vectors up before the shuffle, so a cluster of any size is spread over all of them. Ties go to the smaller
    number. A null id is kept, repeated rows are vectors of their own, other columns are ignored, an empty table gives
    an empty result. A distance that no long holds is the largest long, a sum that none holds is null.
    """
    spark = vectors.sparkSession
    ints = quantised(findable(vectors), dimensions)
    centroids = first_centroids(ints, number, seed)
    if not len(centroids):
        return spark.createDataFrame([], CLUSTERED)
    for _ in range(rounds):
        centroids = improved(ints, centroids)
    assigned = kept(assign(ints, centroids))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("total")).collect()
    inertia = sum(int(row["total"]) for row in sums)

    def long(total: int) -> int | None:
        return total if total <= LONGEST else None

    known = [
        (
            row["cluster"],
            long(int(row["total"])),
            long(inertia),
            hashlib.sha256(",".join(map(str, centroids[row["cluster"]].tolist())).encode()).hexdigest(),
        )
        for row in sums
    ]
    # One row for each centroid.
    clusters = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _round_sql(n: int) -> str:
    """Vectors assigned to the centroids of round ``n``, and what those are moved to."""
    return f"""
near{n} as (
    select key, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance from (
        select v.key, c.cluster, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
               as distance
        from ints v cross join centroids{n} c)
    group by key),
sums{n} as (
    select cluster, i, sum(v[i]) as total, count(*) as vectors
    from ints join near{n} using (key) cross join (select unnest(range(1, {DIMENSIONS + 1})) as i) group by cluster, i),
centroids{n + 1} as (
    select c.cluster, coalesce(m.v, c.v) as v from centroids{n} c
    left join (select cluster, list(cast((total - ((total % vectors) + vectors) % vectors) // vectors as bigint) order by i) as v
               from sums{n} group by cluster) m using (cluster)),"""


CENTROIDS_SQL = f"""
with ints as materialized (
    select row_number() over () as key, vec_id,
           list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
    from embeddings
    where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
centroids0 as (
    select cast(row_number() over (order by drawn, v) - 1 as integer) as cluster, v
    from (select sha256('{SEED}:' || coalesce(cast(vec_id as varchar), '')) as drawn, v from ints
          order by drawn, v limit {CENTROIDS})),
{"".join(_round_sql(n) for n in range(ROUNDS + 1)).replace("as (", "as materialized (")}
rows as (
    select vec_id, n.cluster, n.distance, c.v as centroid
    from near{ROUNDS} n join ints using (key) join centroids{ROUNDS} c using (cluster))
select vec_id, cluster, cast(distance as bigint) as distance,
       cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(centroid, ',')) as centroid_sha256
from rows
"""
