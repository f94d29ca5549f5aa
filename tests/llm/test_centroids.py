"""Centroid clustering against a plain recount in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tillhouse.llm import centroids
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, cluster int, id string, v string, _c int"


def plain(rows, k, dims, scale, rounds):
    """Expected (id, cluster, distance, cluster_inertia, inertia, sha) of rows with ids."""
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    centres = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for c, vs in zip(centres, own)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = {j: sum(d for _, d, c in found if c == j) for j in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, c, d, sums[c], sum(sums.values()), sha[c]) for i, d, c in found)


def test_walk_equals_comparing_with_all():
    rng = np.random.default_rng(3)
    for d, k, spread in ((1, 3, 2), (2, 5, 4), (8, 16, 3), (64, 16, 30), (64, 1, 9), (3, 40, 100)):
        x, c = rng.integers(-spread, spread + 1, (500, d)), rng.integers(-spread, spread + 1, (k, d))
        number, best, steps = centroids.Lists(c).nearest(x)
        away = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (number == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all() and steps <= k


def test_walk_stops_before_all_are_met():
    c = np.arange(100, dtype=np.int64)[:, None] * 1000
    number, best, steps = centroids.Lists(c).nearest(np.array([[50_300], [0], [99_400]]))
    assert number.tolist() == [50, 0, 99] and best.tolist() == [90_000, 0, 160_000] and steps <= 3


def test_far_values_stay_exact():
    top = centroids.LARGEST - 1
    x = np.array([[top] * 64, [-top] * 64, [top - 1] * 64])
    number, best, _ = centroids.Lists(x[:2]).nearest(x)
    assert number.tolist() == [0, 1, 0] and best.tolist() == [0, 0, 64]


@pytest.mark.parametrize("k,rounds", [(4, 3), (50, 2)])
def test_against_a_plain_recount(spark, k, rounds):
    rng = random.Random(k)
    rows = [(i, [rng.choice([-1.5, -0.2, 0.0, 0.01, 0.7, 2.25]) for _ in range(3)]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, 2.0]), (303, [1.0, None, 2.0]), (304, [1.0, float("nan"), 2.0]), (305, [float("inf"), 1.0, 2.0])]
    rows += [rows[7], rows[7], (7, [9.0, 9.0, 9.0])]  # repeated rows, and one id with two vectors
    frame = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(5)
    found = centroids.cluster(frame, k=k, dims=3, scale=8, rounds=rounds)
    assert sorted(map(tuple, found.collect())) == plain(rows, k, 3, 8, rounds)


def test_few_rows_and_none(spark):
    rows = [(5, [1.0, 2.0]), (6, [1.0, 2.0]), (None, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    found = {r["vec_id"]: r for r in centroids.cluster(frame, dims=2).collect()}
    assert set(found) == {5, 6, None} and {r["distance"] for r in found.values()} == {0}
    assert found[5]["cluster"] == found[6]["cluster"] in (0, 1)
    empty = centroids.cluster(frame.limit(0), dims=2)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.cluster(frame, dims=9).count() == 0


def test_query(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_centroid_clustering"](spark, SF).collect())) == plain(rows, 16, 64, 64, 3)
