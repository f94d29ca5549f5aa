"""Byte and word deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillhouse.llm import chunks, suffix, windows
from tillhouse.llm import textkit as kit
from tillhouse.llm.induced import common_prefixes, suffix_array
from tillhouse.llm.queries import QUERIES

NULL_ID = float("-inf")


def expected(rows, units, width, join):
    first = {}
    key = lambda d: NULL_ID if d is None else d
    for d, t in rows:
        u = units(t)
        for i in range(len(u) - width + 1):
            k = join(u[i : i + width])
            first[k] = min(first.get(k, float("inf")), key(d))
    out = []
    for d, t in rows:
        u = units(t)
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            if first[join(u[i : i + width])] < key(d):
                gone[i : i + width] = [True] * width
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(u), sum(gone), spans, hashlib.sha256(join([x for x, g in zip(u, gone) if not g])).hexdigest()))
    return sorted(out, key=str)


def in_bytes(t):
    return (t or "").encode()


def in_words(t):
    return [w.encode() for w in re.split("[\\x20\\x09-\\x0d]+", t or "") if w]


def check(frame, rows, width=50):
    got = sorted(map(tuple, suffix.digest(suffix.dedup_bytes(frame, width=width)).collect()), key=str)
    assert got == expected(rows, in_bytes, width, bytes)
    got = sorted(map(tuple, windows.digest(windows.dedup_words(frame, width=width)).collect()), key=str)
    assert got == sorted(((a, b, c, e) for a, b, c, _, e in expected(rows, in_words, width, b" ".join)), key=str)


def text(rng, n):
    return " ".join(rng.choice(["the", "of", "ä", "stone", "runs", "x" * 30]) + rng.choice(["", str(rng.randint(0, 400))]) for _ in range(n))


def test_passages_copies_and_edges(docs):
    rng = random.Random(3)
    passage = text(rng, 70)
    rows = [(i, text(rng, rng.randint(0, 120))) for i in range(30)]
    rows += [(100 + i, text(rng, 20) + " " + passage + "\n" + text(rng, 20)) for i in range(8)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]
    rows += [(300, "a" * 400), (301, "a" * 200), (302, None), (303, ""), (None, passage), (None, None), (304, "\x00" * 60), (305, "\x00" * 60)]
    rows += [(400, passage), (400, passage), (401, passage * 40), (402, "word " * 300)]
    check(docs(rows), rows)


def test_tiny_windows(docs):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("ab \n") for _ in range(rng.randint(0, 30)))) for i in range(40)]
    for width in (2, 3, 9):
        check(docs(rows), rows, width)


def test_many_chunks(docs, monkeypatch):
    rng = random.Random(5)
    base = [text(rng, 60) for _ in range(20)]
    rows = [(i, " ".join(rng.sample(base, 2)) + " " + text(rng, 10)) for i in range(60)]
    check(docs(rows, parts=15), rows)


def test_empty_table_and_clashing_columns(docs):
    assert suffix.dedup_bytes(docs([])).collect() == []
    frame = docs([(1, "x" * 60, 5, "k"), (2, "x" * 60, None, None)], extra="n_bytes long, kept string")
    got = sorted(tuple(r) for r in suffix.dedup_bytes(frame, as_text=True).select("doc_id", "n_bytes", "n_removed", "text").collect())
    assert got == [(1, 60, 0, "x" * 60), (2, 60, 60, "")]
    frame = docs([(1, "a b c", 5, "k")], extra="n_words long, kept string")
    assert windows.dedup_words(frame).select("n_words", "kept").first() == (3, "a b c")


def test_broken_characters_leave_as_text(docs):
    shared = "é" * 25
    got = suffix.dedup_bytes(docs([(1, shared), (2, "è" + shared[1:] + "zé")]), as_text=True).where("doc_id = 2").first()
    assert got["text"].isprintable()


@pytest.mark.parametrize("name,width,units,join", [("op9_suffix_dedup", 50, in_bytes, bytes), ("op10_substring_dedup", 50, in_words, b" ".join)])
def test_queries_on_the_given_table(spark, name, width, units, join):
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = expected(rows, units, width, join)
    if name.startswith("op10"):
        want = sorted(((a, b, c, e) for a, b, c, _, e in want), key=str)
    assert sorted(map(tuple, QUERIES[name](spark, "/root/testdata/sf0.001").collect()), key=str) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(values):
    s = np.array(values, np.int16)
    assert suffix_array(s, 4).tolist() == sorted(range(len(values)), key=lambda i: values[i:])


def test_common_prefixes():
    raw = np.frombuffer(b"abcabcabcabcabdabcabcab", np.uint8)
    order = np.array(sorted(range(len(raw) - 8), key=lambda i: raw[i:].tobytes()))
    for width in (3, 9):
        order_ = order[order + width <= len(raw)]
        got = common_prefixes(raw, order_, width)
        want = [False] + [raw[a : a + width].tobytes() == raw[b : b + width].tobytes() for a, b in zip(order_, order_[1:])]
        assert got.tolist() == want


def test_a_slice_of_runs_does_not_hash_the_whole_chunk_again(monkeypatch):
    values = np.random.default_rng(3).integers(0, 4, 400).astype(np.uint64)
    halves = kit.window_hash(values, 3)
    monkeypatch.setattr(kit, "window_hash", None)
    first, count = np.array([0, 50, 200]), np.array([40, 100, 190])
    got = np.concatenate([windows.double(halves, first[i : i + 1], count[i : i + 1], 3, 5) for i in range(3)])
    words = [tuple(values[i : i + 5]) for f, n in zip(first, count) for i in range(f, f + n)]
    by_hash, by_words = {}, {}
    assert [by_hash.setdefault(h, i) for i, h in enumerate(got.tolist())] == [by_words.setdefault(w, i) for i, w in enumerate(words)]


def test_windows_are_sent_without_their_hashes():
    rng = np.random.default_rng(4)
    spans = [(int(i), rng.integers(97, 99, int(n)).astype(np.uint8)) for i, n in enumerate(rng.integers(8, 40, 3000))]
    spans += [(5000 + i, raw) for i, raw in spans[:1500]] + [(9000, np.full(400_000, 98, np.uint8))]
    width, payloads = 8, []
    for part in (spans[:2000], spans[2000:]):
        low, raws = zip(*part)
        payloads.append(chunks.pack_arrays(np.array(low), np.array([min(len(r) - width + 1, 60_000) for r in raws], np.uint16), np.concatenate([r[: 60_000 + width - 1] for r in raws])))
    got = np.concatenate(suffix.array_repeats(payloads, width))
    windows_ = [(d, bytes(r[i : i + width])) for d, r in spans for i in range(min(len(r) - width + 1, 60_000))]
    least = {}
    for d, w in windows_:
        least[w] = min(least.get(w, d), d)
    assert got.tolist() == [least[w] < d for d, w in windows_]


def test_shuffle_files_go_when_a_step_is_stored(docs, spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")
    frame = docs([(i, f"{i} " + "the same passage in every text, longer than a window of fifty bytes") for i in range(50)]).localCheckpoint()
    before = files()
    suffix.dedup_bytes(frame)  # all steps but the last one have run
    assert files() <= before
