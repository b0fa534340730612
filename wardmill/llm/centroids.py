"""Centroid clustering of whole-number vectors with Orchard's search for the nearest centroid.

The centroids are few and fixed in number (``CLUSTERS`` times ``SIZE`` whole numbers), so the driver holds them and
every task gets them with, for each centroid, the others in order of their distance from it. A vector walks the
list of its best centroid so far, marks what it has compared, jumps to the list of any closer one, and stops where
the list goes on strictly beyond twice its current distance: by the triangle inequality no centroid there
can be as close. All arithmetic is in whole numbers, so the result does not depend on how rows are dealt.

A round is a scan of the stored vectors; a task gives one row of sums for each centroid, and Spark adds them up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wardmill.llm.common import in_batches, stored
from wardmill.llm.words import frugal

CLUSTERS = 40
ROUNDS = 5
SIZE = 64
SCALE = 256
#: Components are held to this range, in which four times a squared distance fits into a long.
LIMIT = 1 << 26
#: Vectors that walk at once.
ROWS = 4096


def kept_vectors(embeddings: DataFrame, size: int = SIZE) -> DataFrame:
    """(vec_id, v): vectors with exactly ``size`` components, none null or non-finite, as whole numbers
    floor(256 x), held to +-2^26. Other rows go; rows repeated in full all stay; other columns are not read."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(F.least(F.greatest(e * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    good = F.when(F.size(x) == size, finite)
    return embeddings.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def start(vectors: DataFrame, clusters: int = CLUSTERS, rounds_key: str = "2") -> np.ndarray:
    """The first centroids: vectors with the smallest SHA-256 of ``2:<vec_id>``, in ascending order; equal ids by
    their components, vectors without an id last."""
    key = F.sha2(F.concat(F.lit(f"{rounds_key}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(F.asc_nulls_last(key), "v").limit(clusters).select("v").collect()
    return np.array([r["v"] for r in rows], np.int64)


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every centroid the others in order of distance from it (ties: smaller number), and those distances."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    order = np.array([np.lexsort((np.arange(len(centroids)), row)) for row in apart])
    return order, np.take_along_axis(apart, order, axis=1)


def search(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of every vector (ties: smaller number)."""
    n, k = len(vectors), len(centroids)
    rows = np.arange(n)
    at = np.zeros(n, np.int64)  # whose list is walked
    place = np.zeros(n, np.int64)
    gap = vectors - centroids[0]
    distance = np.einsum("ij,ij->i", gap, gap)
    best = at.copy()
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    while len(rows):
        a, p = at[rows], place[rows]
        on = (p < k) & (far[a, np.minimum(p, k - 1)] <= 4 * distance[rows])
        rows, a, p = rows[on], a[on], p[on]
        other = order[a, p]
        place[rows] = p + 1
        new = ~seen[rows, other]
        r, c = rows[new], other[new]
        seen[r, c] = True
        gap = vectors[r] - centroids[c]
        d = np.einsum("ij,ij->i", gap, gap)
        closer = d < distance[r]
        even = (d == distance[r]) & (c < best[r])
        best[r[closer | even]] = c[closer | even]
        r, c, d = r[closer], c[closer], d[closer]
        at[r], place[r], distance[r] = c, 0, d
    return best, distance


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)


def _walk(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
    """(ids, vectors, nearest, distance) for blocks of rows."""
    order, far = neighbours(centroids)
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            vectors = _matrix(part.column("v"), centroids.shape[1])
            yield part.column("vec_id"), vectors, *search(vectors, centroids, order, far)


def _sums(centroids: np.ndarray) -> Callable:
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, vectors, nearest, _ in _walk(batches, centroids):
            by = np.argsort(nearest, kind="stable")
            met, first = np.unique(nearest[by], return_index=True)
            total[met] += np.add.reduceat(vectors[by], first, axis=0)
            count += np.bincount(nearest, minlength=len(count))
        held = np.flatnonzero(count)
        if len(held):
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.astype(np.int32)), pa.array(count[held]), pa.array(list(total[held]), pa.list_(pa.int64()))],
                names=["cluster", "n", "total"],
            )

    return run


def _assigned(centroids: np.ndarray) -> Callable:
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, nearest, distance in _walk(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: each floor(sum / count) of its vectors, an empty one as before."""
    parts = vectors.transform(in_batches, _sums(centroids), "cluster int, n long, total array<long>")
    parts = parts.select("cluster", "n", F.posexplode("total").alias("c", "x"))
    added = parts.groupBy("cluster", "c").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()  # CLUSTERS * SIZE
    out = centroids.copy()
    for r in added:
        out[r["cluster"], r["c"]] = r["x"] // r["n"]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    return vectors.transform(in_batches, _assigned(centroids), "vec_id long, cluster int, distance long")


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(assignments of every kept vector, final centroids). With fewer vectors than clusters every vector starts a
    centroid; without any vector there are no rows and no centroids."""
    vectors = stored(kept_vectors(embeddings))
    centroids = start(vectors, clusters)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return assign(vectors, centroids), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add cluster_inertia, inertia (sums of distance; null beyond a long) and centroid_sha256."""
    found = stored(found)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(wide.alias("own"))  # one row for each centroid
    sums = sums.withColumn("whole", F.sum("own").over(Window.partitionBy()))
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    names = F.from_json(F.lit(json.dumps(names)), "array<string>")
    return found.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", F.col("own").try_cast("long").alias("cluster_inertia"),
        F.col("whole").try_cast("long").alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"),
    )
