"""Nearest neighbours against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillhouse.llm import neighbours
from tillhouse.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, rank int, row long, cell int, asks boolean"


def brute(ids, x, asks, k):
    """(query, rank, id, score) of all queries; ids may repeat, a row is not its own neighbour."""
    out = []
    for i in np.flatnonzero(asks):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out += [(int(ids[i]), r + 1, int(ids[j]), float(d[j])) for r, j in enumerate(order)]
    return out


def frame(spark, ids, x, parts=5):
    return spark.createDataFrame([(int(i), list(map(float, v)), 0, 0, 0, True) for i, v in zip(ids, x)], SCHEMA).repartition(parts)


def recall(found, want):
    """Share of the wanted rows whose score is among those found for the query (equal scores are as good)."""
    have = {}
    for q, _, _, s in found:
        have.setdefault(q, []).append(s)
    last = {q: max(v) for q, v in have.items()}
    return sum(s <= last.get(q, -1) + 1e-9 and any(abs(s - t) < 1e-9 for t in have[q]) for q, _, _, s in want) / len(want)


def test_chi_square_limit():
    assert neighbours.chi_square_limit(8, 0.95) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_limit(2, 0.5) == pytest.approx(2 * math.log(2))


def test_tree_cells_hold_all_rows_and_shards_stop_early():
    rng = np.random.default_rng(1)
    x = np.concatenate((rng.normal(size=(3000, 16)), np.repeat(rng.normal(size=(1, 16)), 1500, axis=0)))
    p = neighbours.projected(x, 8)
    tree = neighbours.top_tree(p, 32)
    cells = neighbours.cell_of(tree, p)
    assert 20 <= len(np.unique(cells)) <= 32 and len(set(cells[3000:].tolist())) == 1
    rows = np.arange(len(x))
    shard = neighbours.Shard(rows, rows, x, p)
    assert sorted(shard.row.tolist()) == rows.tolist() and np.diff(shard.bounds).max() <= neighbours.LEAF_ROWS
    limit = neighbours.chi_square_limit(8, 0.95)
    (q, at, d), measured = shard.search(rows[3000:3010], x[3000:3010], p[3000:3010], np.full(10, np.inf), 5, limit)
    assert (d == 0).all() and measured < 10 * len(x) / 2
    assert [shard.ids[at[q == i]].tolist() for i in (0, 9)] == [[3001, 3002, 3003, 3004, 3005], [3000, 3001, 3002, 3003, 3004]]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 32)) * 3
    x = np.concatenate((rng.normal(size=(1500, 32)), centres[rng.integers(0, 20, 1500)] + 0.3 * rng.normal(size=(1500, 32))))
    ids = rng.permutation(len(x))
    found = list(map(tuple, neighbours.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0).collect()))
    want = brute(ids, x, ids % 20 == 0, 10)
    assert recall(found, want) >= 0.95 and len(found) == len(want)
    place = {int(i): v for i, v in zip(ids, x)}
    for q, _, i, s in found:
        assert q != i and s == pytest.approx(math.dist(place[q], place[i]), rel=1e-12)
    for q in {f[0] for f in found}:
        own = sorted(f for f in found if f[0] == q)
        assert [f[1] for f in own] == list(range(1, 11)) and own == sorted(own, key=lambda f: (f[3], f[2]))


def test_a_hot_vector_and_ties_over_split_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(size=(400, 8)), np.repeat(rng.normal(size=(1, 8)), 300, axis=0)))
    ids = rng.permutation(len(x))
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 50)
    found = sorted(map(tuple, neighbours.nearest(frame(spark, ids, x), F.col("vec_id") % 7 == 0, k=4, confidence=0.999999).collect()))
    want = sorted(brute(ids, x, ids % 7 == 0, 4))
    assert [f[:3] for f in found] == [w[:3] for w in want]


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0]), (8, [1.0]), (10, [3.0])]
    data = spark.createDataFrame([(*r, 0, 0, 0, None) for r in rows], SCHEMA).repartition(3)
    found = sorted(neighbours.nearest(data, F.col("vec_id") % 2 == 0, k=3).collect(), key=lambda r: (r[0], r[1]))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found]
    # both rows with id 0 ask, and find each other; a null id comes after the others; lengths do not mix
    assert got == [(0, 1, 0, 0.0)] * 2 + [(0, 2, None, 0.0)] * 2 + [(0, 3, 1, 1.0)] * 2 + [(8, 1, 10, 2.0), (10, 1, 8, 2.0)]
    assert neighbours.nearest(data.limit(0)).count() == 0
    assert neighbours.nearest(data, F.col("vec_id") == 99).count() == 0
    assert neighbours.nearest(data, F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    found = list(map(tuple, QUERIES["op13_nearest_neighbours"](spark, f"/root/testdata/{sf}").collect()))
    want = brute(ids, x, ids % 100 == 0, 10)
    assert len(found) == len(want) and recall(found, want) >= 0.95
