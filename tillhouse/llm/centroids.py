"""Clustering of vectors around centroids, in exact integers, with the threshold algorithm.

Every component is scaled and floored. Assigning a vector does not compare it with all centroids: for each dimension the
centroids are sorted by that component, and all these lists are walked outward from the vector's own value at the same time.
A centroid is measured in full when it is met for the first time. A centroid not met in any list is at least as far
away as the sum of the squared frontier distances, so the walk ends as soon as that sum is strictly larger than the best
distance found (or nothing is left to meet); with a strict test, ties still go to the smaller number.

Only centroids and their sums, ``k`` times the number of dimensions, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.ship import ship_package
from tillhouse.llm.vectors import finite, lists, matrix
from tillhouse.session import materialize

LARGEST = 1 << 27  # of a scaled component, so that squared distances of 64 dimensions fit into 64 bits
BLOCK = 2048
_FAR = np.int64(1 << 30)


class Lists:
    """The centroids, and for every dimension the list of their components in ascending order."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k, d = centroids.shape
        order = np.argsort(centroids, axis=0, kind="stable").T
        values = np.take_along_axis(centroids.T, order, axis=1)
        side = np.full((d, 1), _FAR)
        self.order = order
        self.values = np.concatenate((-side, values, side), axis=1)  # one place beyond each end

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each row, and how many steps the longest walk took."""
        n, d = x.shape
        k = len(self.centroids)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64)
        met = np.zeros((n, k), bool)
        rows, dim, flat = np.arange(n), np.arange(d), self.values.reshape(-1)
        start = dim * (k + 2)
        left = np.stack([np.searchsorted(self.values[j, 1:-1], x[:, j], side="right") for j in range(d)], axis=1) + start
        right = left + 1
        steps = 0
        while len(rows):
            steps += 1
            at = x[rows]
            go_right = flat[right] - at < at - flat[left]
            place = np.where(go_right, right, left) - start
            inside = (place >= 1) & (place <= k)
            r, j = np.nonzero(inside)
            new = np.zeros((len(rows), k), bool)
            new[r, self.order[j, place[r, j] - 1]] = True
            new &= ~met[rows]
            met[rows] |= new
            for c in np.flatnonzero(new.any(axis=0)).tolist():
                own = rows[new[:, c]]
                away = ((x[own] - self.centroids[c]) ** 2).sum(axis=1)
                closer = (away < best[own]) | ((away == best[own]) & (c < number[own]))
                best[own[closer]], number[own[closer]] = away[closer], c
            right += go_right & inside
            left -= ~go_right & inside
            frontier = np.minimum(flat[right] - at, at - flat[left])
            bound = (np.minimum(frontier, _FAR).astype(np.float64) ** 2).sum(axis=1)
            # the float sum only decides far from the limit; near it the exact sum does
            near = np.abs(bound - best[rows]) <= bound * 1e-9
            open_ = bound <= best[rows]
            if near.any():
                open_[near] = (frontier[near] ** 2).sum(axis=1) <= best[rows[near]]
            open_ &= ~met[rows].all(axis=1)
            rows, left, right = rows[open_], left[open_], right[open_]
        return number, best, steps


def scaled(rows: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``id, v``: the vectors with exactly ``dims`` finite components, each as the integer ``floor(scale * x)``."""
    x = F.col(vector).cast("array<double>")
    floor = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))))
    huge = F.exists("x", lambda c: F.abs(c) * scale >= LARGEST)
    kept = rows.select(F.col(vec_id).cast("long").alias("id"), x.alias("x")).where(finite(F.col("x")) & (F.size("x") == dims))
    fits = F.when(huge, F.raise_error(F.lit(f"a scaled component is not below {LARGEST}"))).otherwise(floor)
    return kept.select("id", fits.cast("array<int>").alias("v"))


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of every vector."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Lists(centroids)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                number, best, _ = walk.nearest(matrix(part.column("v"), dims, np.int64))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(number.astype(np.int32)), pa.array(best)], names=["id", "cluster", "distance"])

    return kept.mapInArrow(run, "id long, cluster int, distance long")


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floored mean of what each is nearest to; those without a vector stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Lists(centroids)
        sums = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                x = matrix(batch.slice(at, BLOCK).column("v"), dims, np.int64)
                number, _, _ = walk.nearest(x)
                for c in np.unique(number).tolist():
                    own = x[number == c]
                    sums[c, :dims] += own.sum(axis=0)
                    sums[c, dims] += len(own)
        full = np.flatnonzero(sums[:, dims])
        if len(full):
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), lists(sums[full])], names=["cluster", "sums"])

    parts = kept.mapInArrow(run, "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("place", "part"))
    total = {(r["cluster"], r["place"]): r["total"] for r in parts.groupBy("cluster", "place").agg(F.sum("part").alias("total")).collect()}
    out = centroids.copy()
    for c in range(k):
        count = total.get((c, dims), 0)
        if count:
            out[c] = [total[c, j] // count for j in range(dims)]
    return out


def cluster(
    rows: DataFrame, k: int = 16, dims: int = 64, scale: int = 64, rounds: int = 3, seed: str = "1", vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector with ``dims`` finite components.

    The first centroids are the ``k`` vectors with the smallest ``sha256(seed:id)``, in that order. Every round assigns all
    vectors to the nearest centroid (squared Euclidean distance, ties to the smaller number) and moves every non-empty
    centroid to the floored mean; then all vectors are assigned once more.

    Null vectors, vectors of another length and those with null or non-finite components are left out. Repeated rows count
    each. Rows with a null id are clustered, but become first centroids only after all others; equal ids are ordered by
    their vectors. With fewer than ``k`` vectors there are as many centroids as vectors; without any the result is empty.
    Other columns are not looked at. A scaled component of 2^27 or more ends the job with an error: distances would overflow.
    """
    spark = rows.sparkSession
    ship_package(spark)
    kept = materialize(scaled(rows, vec_id, vector, dims, scale), "scaled")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.withColumn("_order", order).orderBy(F.asc_nulls_last("_order"), "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in first], np.int64)
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    found = materialize(assigned(kept, centroids), "assigned")
    sums = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = sum(sums.values())
    table = spark.createDataFrame([(c, sums[c], whole, digest[c]) for c in sorted(sums)], "_c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), F.col("cluster") == F.col("_c")).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
