"""Nearest neighbours through a few stable projections, a kd-tree over them, and a chi-square stopping test.

A Gaussian projection onto ``m`` dimensions turns a distance ``d`` into a random one with ``(projected / d)^2`` chi-square
distributed with ``m`` degrees of freedom. So a query takes candidates by growing projected distance and measures them on the
original vectors; once the projected distance is so large that a point as near as the k-th best would lie within it
with probability ``confidence``, the search stops. Every such point is found with at least that probability, whatever the data.

The upper levels of the tree split a bounded sample; its cells (at most ``MOST_CELLS``) hold all rows, with boxes taken over
all rows. A cell with more than ``SHARD_ROWS`` rows, as one vector in a third of all rows makes it, is split by row
number into shards. A shard's rows stay together in one task, which builds the lower levels and then streams
the queries past them. Queries go to their own cell first, and with the k-th distance found there to all cells whose boxes the
stopping test does not exclude. Only the sample and the boxes, both bounded, pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.ship import ship_package
from tillhouse.llm.vectors import finite, lists, matrix
from tillhouse.session import materialize

SAMPLE_ROWS = 1 << 16
LEAST_CELLS = 64
MOST_CELLS = 1 << 12
SHARD_ROWS = 1 << 16
LEAF_ROWS = 256
QUERIES = 512  # of a shard, searched together
NO_ID = np.iinfo(np.int64).max
_SLACK = 1e-9  # for sums that are rounded in another order


def chi_square_limit(m: int, confidence: float) -> float:
    """The value that a chi-square variable with ``m`` (even) degrees of freedom stays below with ``confidence``."""
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
    lo, hi = 0.0, 1.0
    while below(hi) < confidence:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < confidence else (lo, mid)
    return hi


def projected(v: np.ndarray, m: int) -> np.ndarray:
    """Gaussian projections; summed in one order, so that equal vectors keep equal ones."""
    onto = np.random.default_rng([v.shape[1], m]).standard_normal((v.shape[1], m))
    out = np.zeros((len(v), m))
    for x, row in zip(v.T, onto):
        out += x[:, None] * row
    return out


def split(points: np.ndarray, rows: np.ndarray, least: int) -> tuple[int, float, np.ndarray, np.ndarray] | None:
    """Dimension, value and the two sides of a cut at the median of the widest dimension; None where it can't be cut."""
    if len(rows) <= least:
        return None
    own = points[rows]
    j = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
    x = own[:, j]
    cut = float(np.partition(x, len(x) // 2)[len(x) // 2])
    below = x < cut
    if not below.any():
        below = x <= cut
        if below.all():
            return None
        cut = float(x[~below].min())
    return j, cut, rows[below], rows[~below]


def top_tree(points: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """Nodes ``(dimension, cut, left, right)`` over a sample; a negative child ``-1 - c`` is cell ``c``. Empty: one cell."""
    nodes: list[list] = []
    open_: list[tuple[np.ndarray, int | None, int]] = [(np.arange(len(points)), None, 0)]
    leaves: list[tuple[int | None, int]] = []
    while open_:
        open_.sort(key=lambda x: -len(x[0]))
        rows, parent, side = open_.pop(0)
        cut = split(points, rows, 1) if len(leaves) + len(open_) + 1 < cells else None
        if cut is None:
            leaves.append((parent, side))
            continue
        j, value, low, high = cut
        if parent is not None:
            nodes[parent][2 + side] = len(nodes)
        nodes.append([j, value, 0, 0])
        open_ += [(low, len(nodes) - 1, 0), (high, len(nodes) - 1, 1)]
    for c, (parent, side) in enumerate(leaves):
        if parent is not None:
            nodes[parent][2 + side] = -1 - c
    return [tuple(n) for n in nodes]


def cell_of(tree: list[tuple[int, float, int, int]], p: np.ndarray) -> np.ndarray:
    out = np.zeros(len(p), np.int32)
    if not tree:
        return out
    todo = [(0, np.arange(len(p)))]
    while todo:
        node, rows = todo.pop()
        j, cut, low, high = tree[node]
        below = p[rows, j] < cut
        for child, own in ((low, rows[below]), (high, rows[~below])):
            if child < 0:
                out[own] = -1 - child
            elif len(own):
                todo.append((child, own))
    return out


def box_distances(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of each point from each box."""
    out = np.zeros((len(p), len(lo)))
    for j in range(p.shape[1]):
        x = p[:, j : j + 1]
        gap = np.maximum(np.maximum(lo[:, j] - x, x - hi[:, j]), 0)
        out += gap * gap
    return out


class Shard:
    """The rows of a shard in the order of their leaves, and a box around each leaf."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, v: np.ndarray, p: np.ndarray):
        leaves, open_ = [], [np.arange(len(row))]
        while open_:
            rows = open_.pop()
            cut = split(p, rows, LEAF_ROWS)
            if cut is None:
                leaves += [rows[i : i + LEAF_ROWS] for i in range(0, len(rows), LEAF_ROWS)]
            else:
                open_ += [cut[3], cut[2]]
        order = np.concatenate(leaves)
        self.bounds = np.append(0, np.cumsum([len(x) for x in leaves]))
        self.row, self.ids, self.v, self.p = row[order], ids[order], v[order], p[order]
        self.norm = (self.v * self.v).sum(axis=1)
        self.p_norm = (self.p * self.p).sum(axis=1)
        self.lo = np.minimum.reduceat(self.p, self.bounds[:-1])
        self.hi = np.maximum.reduceat(self.p, self.bounds[:-1])

    def search(self, own: np.ndarray, q: np.ndarray, qp: np.ndarray, bound: np.ndarray, k: int, limit: float):
        """The up to ``k`` nearest rows of each query at most ``bound`` away: ``(query, place, distance)``, and pairs measured.

        ``own`` is the row number of each query. Leaves are taken by growing projected distance, 1, 1, 2, 4, ... at a time; within
        them only points that the stopping test does not exclude are measured.
        """
        away = box_distances(qp, self.lo, self.hi)
        order = np.argsort(away, axis=1, kind="stable")
        n, leaves = away.shape
        bound = bound.copy()
        q_norm, qp_norm = (q * q).sum(axis=1), (qp * qp).sum(axis=1)
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        measured, lo, hi = 0, 0, 1
        while lo < leaves:
            turn = order[:, lo:hi]
            reach = bound * bound * limit + _SLACK * (1 + qp_norm)
            fits = np.take_along_axis(away, turn, axis=1) <= reach[:, None]
            if not fits.any():
                break  # leaves further out are further away
            who, leaf = np.nonzero(fits)[0], turn[fits]
            by_leaf = np.argsort(leaf, kind="stable")
            who, leaf = who[by_leaf], leaf[by_leaf]
            edges = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
            for i, j in zip(edges.tolist(), np.append(edges[1:], len(leaf)).tolist()):
                a, b = self.bounds[leaf[i]], self.bounds[leaf[i] + 1]
                w = who[i:j]
                reach = bound[w] * bound[w] * limit + _SLACK * (1 + qp_norm[w])
                shadow = qp_norm[w, None] + self.p_norm[a:b] - 2 * (qp[w] @ self.p[a:b].T)
                seen = ~(shadow > reach[:, None])
                measured += int(seen.sum())
                rough = q_norm[w, None] + self.norm[a:b] - 2 * (q[w] @ self.v[a:b].T)
                most = bound[w] * bound[w] + _SLACK * (q_norm[w] + self.norm[a:b].max())
                seen &= ~(rough > most[:, None])
                x, y = np.nonzero(seen)
                x, y = w[x], y + a
                other = self.row[y] != own[x]
                x, y = x[other], y[other]
                if not len(x):
                    continue
                d = np.sqrt(((self.v[y] - q[x]) ** 2).sum(axis=1))
                near = d <= bound[x]
                kept = self._best(tuple(np.concatenate(z) for z in zip(kept, (x[near], y[near], d[near]))), k)
                full = np.flatnonzero(np.bincount(kept[0], minlength=n) >= k)
                last = np.searchsorted(kept[0], full, side="right") - 1
                bound[full] = np.minimum(bound[full], kept[2][last])
            lo, hi = hi, hi * 2
        return kept, measured

    def _best(self, found, k: int):
        x, y, d = found
        order = np.lexsort((self.row[y], self.ids[y], d, x))
        x, y, d = x[order], y[order], d[order]
        head = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)
        rank = np.arange(len(x)) - np.repeat(head, np.diff(np.append(head, len(x))))
        return x[rank < k], y[rank < k], d[rank < k]


def _points(rows: DataFrame, dims: int, m: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = projected(matrix(batch.column("v"), dims), m)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("v"), lists(p)], names=["row", "id", "v", "p"])

    return rows.select("row", "id", "v").mapInArrow(run, "row long, id long, v array<double>, p array<double>")


def _in_cells(points: DataFrame, tree: list, m: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cell_of(tree, matrix(batch.column("p"), m))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    return points.mapInArrow(run, "row long, id long, v array<double>, p array<double>, cell int")


def _searched(points: DataFrame, asked: DataFrame, dims: int, m: int, k: int, limit: float) -> DataFrame:
    """``q, row, id, distance``: of each request the up to ``k`` nearest rows of its shard within its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, held = None, None, []
        for batch in batches:
            numbers, kinds = batch.column("shard").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                if i == j:
                    continue
                part = batch.slice(i, j - i)
                row, ids = part.column("row").to_numpy(), part.column("id").to_numpy()
                v, p = matrix(part.column("v"), dims), matrix(part.column("p"), m)
                if numbers[i] != at:
                    at, shard, held = numbers[i], None, []
                if not kinds[i]:
                    held.append((row, ids, v, p))
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard, held = Shard(*(np.concatenate(x) for x in zip(*held))), []
                bound = part.column("bound").to_numpy()
                for b in range(0, len(row), QUERIES):
                    s = slice(b, b + QUERIES)
                    (x, y, d), _ = shard.search(row[s], v[s], p[s], bound[s], k, limit)
                    yield pa.RecordBatch.from_arrays([pa.array(row[s][x]), pa.array(shard.row[y]), pa.array(shard.ids[y]), pa.array(d)], names=["q", "row", "id", "distance"])

    both = points.select("shard", F.lit(False).alias("asks"), "row", "id", "v", "p", F.lit(0.0).alias("bound")).unionByName(
        asked.select("shard", F.lit(True).alias("asks"), "row", "id", "v", "p", "bound")
    )
    return both.repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(run, "q long, row long, id long, distance double")


def _asked(queries: DataFrame, boxes: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], m: int, limit: float, first: bool) -> DataFrame:
    """A request per query and shard: the first shard of its own cell, or all others that the stopping test does not exclude."""
    lo, hi, start, shards = boxes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), QUERIES):
                part = batch.slice(at, QUERIES)
                p, bound, home = matrix(part.column("p"), m), part.column("bound").to_numpy(), start[part.column("cell").to_numpy()]
                if first:
                    who, shard = np.arange(len(part)), home
                else:
                    reach = bound * bound * limit + _SLACK * (1 + (p * p).sum(axis=1))
                    who, cell = np.nonzero(box_distances(p, lo, hi) <= reach[:, None])
                    many = shards[cell]
                    who, cell = np.repeat(who, many), np.repeat(cell, many)
                    shard = start[cell] + np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
                    other = shard != home[who]
                    who, shard = who[other], shard[other]
                out = part.take(pa.array(who))
                yield pa.RecordBatch.from_arrays([pa.array(shard), *(out.column(c) for c in ("row", "id", "v", "p", "bound"))], names=["shard", "row", "id", "v", "p", "bound"])

    return queries.select("row", "id", "v", "p", "cell", "bound").mapInArrow(run, "shard long, row long, id long, v array<double>, p array<double>, bound double")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy("distance", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(rows: DataFrame, dims: int, k: int, m: int, limit: float) -> DataFrame:
    """``q, row, id, distance`` of the nearest found among rows that all have ``dims`` components."""
    points = materialize(_points(rows, dims, m), "projected")
    n = points.count()
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << max(0, math.ceil(math.log2(max(n, 1) / SHARD_ROWS)))))
    share = min(1.0, SAMPLE_ROWS / max(n, 1))  # rows chosen by hash: about SAMPLE_ROWS of them, or all
    sample = points.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("p").toArrow()
    tree = top_tree(matrix(sample["p"], m), cells)
    points = materialize(_in_cells(points, tree, m), "cells")
    ranges = [f(F.col("p")[j]).alias(f"{name}{j}") for name, f in (("lo", F.min), ("hi", F.max)) for j in range(m)]
    found = {r["cell"]: r for r in points.groupBy("cell").agg(F.count("*").alias("n"), *ranges).collect()}
    size = max(found) + 1
    lo, hi, shards = np.full((size, m), np.inf), np.full((size, m), -np.inf), np.zeros(size, np.int64)
    for c, r in found.items():
        lo[c], hi[c], shards[c] = [r[f"lo{j}"] for j in range(m)], [r[f"hi{j}"] for j in range(m)], -(-r["n"] // SHARD_ROWS)
    start = np.cumsum(shards) - shards
    boxes = lo, hi, start, shards
    place = points.sparkSession.createDataFrame([(c, int(start[c]), int(shards[c])) for c in found], "cell int, start long, shards long")
    sharded = points.join(F.broadcast(place), "cell").withColumn("shard", F.col("start") + F.pmod(F.xxhash64("row"), F.col("shards")))
    queries = rows.where("asks").select("row").join(points, "row") if n else points.limit(0)
    queries = materialize(queries.withColumn("bound", F.lit(float("inf"))), "queries")
    near = materialize(_searched(sharded, _asked(queries, boxes, m, limit, True), dims, m, k, limit), "near")
    reached = near.groupBy("q").agg(F.count("*").alias("found"), F.max("distance").alias("last")).where(F.col("found") >= k).select(F.col("q").alias("row"), "last")
    bounded = queries.drop("bound").join(reached, "row", "left").withColumn("bound", F.coalesce("last", F.lit(float("inf"))))
    far = _searched(sharded, _asked(bounded, boxes, m, limit, False), dims, m, k, limit)
    return _top(near.unionByName(far), k)


def nearest(
    rows: DataFrame,
    asks=None,
    k: int = 10,
    confidence: float = 0.95,
    m: int = 8,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``asks`` (a condition on ``rows``; default: all) its ``k`` nearest others.

    The score is the Euclidean distance of the original vectors in double precision; ties go to the smaller id, null ids last. A
    row that is as near as the k-th neighbour is found with probability ``confidence`` at least, a nearer one more often.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part. Vectors of different lengths are never
    compared. Rows that share an id or are equal are rows of their own: each can be a query, and each is a candidate for
    the others. A null condition is no query. An empty table, or one without queries, gives an empty result. Other
    columns are not looked at.
    """
    if m % 2:
        raise ValueError("the number of projections must be even")
    spark = rows.sparkSession
    ship_package(spark)
    limit = chi_square_limit(m, confidence)
    wanted = F.coalesce(asks, F.lit(False)) if asks is not None else F.lit(True)
    part = rows.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("id"), wanted.alias("asks"), F.col(vector).cast("array<double>").alias("v"))
    part = part.where(finite(F.col("v")) & F.exists("v", lambda x: x != 0)).withColumn("row", F.monotonically_increasing_id())
    part = materialize(part, "vectors")  # fixes the row numbers
    out = None
    for r in part.groupBy(F.size("v").alias("dims")).agg(F.count_if("asks").alias("n")).orderBy("dims").collect():
        if r["n"]:
            found = _search(part.where(F.size("v") == r["dims"]), r["dims"], k, m, limit)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ids = part.where("asks").select(F.col("row").alias("q"), F.nullif("id", F.lit(NO_ID)).alias("query_id"))
    return out.join(ids, "q").select("query_id", F.col("rank").cast("int").alias("rank"), F.nullif("id", F.lit(NO_ID)).alias("vec_id"), F.col("distance").alias("score"))
