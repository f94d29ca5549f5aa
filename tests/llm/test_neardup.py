"""Near-duplicates against brute force over all pairs that share a shingle."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from tillhouse.llm import neardup
from tillhouse.llm.components import components
from tillhouse.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    sets, parent, posting = {}, {d: d for d, _ in rows}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, t in rows:
        w = [x for x in re.split("[\\x20\\x09-\\x0d]+", (t or "").translate(LOW)) if x]
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[d], both = s, defaultdict(int)
        for x in s:
            for e in posting[x]:
                both[e] += 1
            posting[x].append(d)
        for e, n in both.items():
            if 100 * n >= 85 * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d, _ in rows)


def run(frame):
    return sorted(map(tuple, neardup.near_duplicates(frame).collect()), key=lambda r: (r[0] is None, r[0], str(r)))


def families(rng, groups, size, words):
    rows, key = [], 0
    for _ in range(groups):
        base = [f"w{rng.randint(0, 300)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
            rows.append((key, " ".join(copy)))
            key += 1
    return rows


def test_families(docs):
    rng = random.Random(1)
    rows = families(rng, 12, 9, 150)
    rows += [(1000, None), (1001, ""), (1002, "one Two"), (1003, "ONE two"), (1004, "one two three"), (1005, rows[0][1].upper())]
    rng.shuffle(rows)
    assert run(docs(rows)) == expected(rows)


def test_big_nodes_branch_and_split(docs, monkeypatch):
    monkeypatch.setattr(neardup, "NODE_ROWS", 16)
    monkeypatch.setattr(neardup, "GROUP_ROWS", 16)
    monkeypatch.setattr(neardup, "DEPTH", 3)
    rng = random.Random(2)
    rows = families(rng, 2, 60, 120)
    assert run(docs(rows)) == expected(rows)


def test_null_and_repeated_ids(docs):
    same = " ".join(f"w{i}" for i in range(30))
    got = run(docs([(5, same), (5, same), (7, same), (8, "other text of some five words")]))
    assert got == [(5, 26, 5, True), (5, 26, 5, True), (7, 26, 5, False), (8, 2, 8, True)]
    got = run(docs([(None, same), (3, same)]))
    assert got == [(3, 26, None, False), (None, 26, None, True)]


def test_empty_table(docs):
    assert run(docs([])) == []


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(30)] + [(rng.randint(300, 340), rng.randint(300, 340)) for _ in range(30)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(want) and dict(map(tuple, got)) == want


def test_query_on_the_given_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op7_near_dedup"](spark, "/root/testdata/sf0.001").collect())) == expected(rows)


def test_recall_at_lower_limits(docs):
    """Pairs just above the limit: a common beginning and two different ends."""
    rng = random.Random(6)
    for percent in (50, 60, 70, 80):
        rows, words = [], 160
        common = next(a for a in range(5, words) if 100 * (a - 4) >= percent * (2 * (words - 4) - (a - 4)))
        for pair in range(80):
            base = [f"b{pair}_{i}" for i in range(common)]
            for side in (0, 1):
                rows.append((2 * pair + side, " ".join(base + [f"e{rng.randrange(10**9)}" for _ in range(words - common)])))
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(rows), percent=percent).collect()}
        found = sum(got[2 * p + 1] == 2 * p for p in range(80))
        assert found >= 0.9 * 80 and all(got[2 * p] == 2 * p for p in range(80))
        assert neardup.least_equal(percent / 100) <= neardup.MOST_EQUAL
