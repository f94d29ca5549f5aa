"""The pipeline's near-duplicate stage against brute force over all pairs at similarity 0.8."""

from __future__ import annotations

import random

import corpus_pipeline

WORDS = 100


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def kept_by_brute_force(rows):
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d for d, _ in rows if find(d) == d}


def test_stage_joins_pairs_from_080_on(spark, docs):
    rng = random.Random(8)
    rows = []
    for family in range(20):
        base = [f"w{family}x{i}" for i in range(WORDS)]
        # changed words far apart: two leave 86 of 106 shingles (0.81), three leave 81 of 111 (0.73)
        for changes in (0, 2, 3):
            copy = list(base)
            for k in range(changes):
                copy[15 + 30 * k + rng.randint(0, 9)] = f"e{rng.randint(0, 10**9)}"
            rows.append((len(rows), " ".join(copy)))
    planted = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::3], rows[1::3])]
    assert all(0.80 <= s < 0.85 for s in planted)
    got = corpus_pipeline.near_dedup(spark, docs(rows), "")
    assert got.columns == ["doc_id", "text"]
    assert {r["doc_id"] for r in got.collect()} == kept_by_brute_force(rows) == {d for d, _ in rows if d % 3 != 1}
