"""Windows that occur in several documents: the passes that exact substring operators share.

A document is a string of units (bytes or words). A window of ``width`` units is a repeat when the same window also
starts in a document with a smaller id. Nothing is sampled away:

1. Every window picks a seed inside it by its content alone, so that equal windows pick equal seeds. Each chunk sends
   the hashes of its distinct seeds to buckets (32 bits; a false match only costs work) and learns which of them other
   documents have as well.
2. Windows on repeated seeds go on: each chunk sends the distinct runs of windows around such a seed, once per chunk
   with the smallest document id, to the seed's bucket. There the operator finds for each window whether a smaller
   document has it, and answers with one bit.
3. Each chunk marks the units that its repeats cover.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import chunks as ch
from tillhouse.llm import textkit as kit
from tillhouse.session import materialize

U = np.uint64
NO_ID = np.iinfo(np.int64).min  # a missing document id counts as smaller than any other


@dataclass
class Units:
    """The units of a chunk: hash value of each, the range of each document, and each document's id."""

    values: Callable[[int, int], np.ndarray]
    bounds: np.ndarray
    ids: np.ndarray


@dataclass
class Runs:
    """Consecutive windows of one document that picked the same seed."""

    first: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    unique: np.ndarray  # distinct seed hashes, ordered by bucket
    seed: np.ndarray  # index into unique
    bucket: np.ndarray  # of each distinct seed


def document_ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy().astype(np.int64, copy=False)


def seed_runs(units: Units, seed: int, width: int, buckets: int) -> Runs:
    n = int(units.bounds[-1])
    firsts, counts, hashes = [], [], []
    # a window may start only where it ends inside the same document
    ends = np.repeat(units.bounds[1:], np.diff(units.bounds))
    for lo, at, h in kit.winnow(units.values, n, seed, width):
        starts = np.arange(lo, lo + len(at))
        ok = starts + width <= ends[lo : lo + len(at)]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
        head = np.flatnonzero(ok & fresh)
        if not len(head):
            continue
        # a run ends where the next one starts or the first window that does not fit begins
        stop = np.flatnonzero(fresh | ~ok)
        nxt = np.append(stop, len(at))[np.searchsorted(stop, head, side="right")]
        firsts.append(head + lo)
        counts.append(nxt - head)
        hashes.append(h[head])
    if not firsts:
        z = np.zeros(0, np.int64)
        return Runs(z, z, z, z.astype(U), z, z)
    first, count, h = np.concatenate(firsts), np.concatenate(counts), np.concatenate(hashes)
    unique, back = np.unique(h, return_inverse=True)
    bucket = ((unique >> U(32)) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Runs(first, count, np.searchsorted(units.bounds, first, side="right") - 1, unique[order], place[back], bucket[order])


def by_bucket(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of an array sorted by bucket."""
    if not len(bucket):
        return []
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return list(zip(bucket[edge].tolist(), edge.tolist(), np.append(edge[1:], len(bucket)).tolist()))


def ask_seeds(chunk: int, runs: Runs, ids: np.ndarray) -> list:
    """Distinct seeds for each bucket, with a mark on those that several documents of this chunk have."""
    n = len(runs.unique)
    doc = ids[runs.doc]
    low = np.full(n, np.iinfo(np.int64).max)
    high = np.full(n, NO_ID)
    np.minimum.at(low, runs.seed, doc)
    np.maximum.at(high, runs.seed, doc)
    many = low < high
    short = runs.unique.astype(np.uint32)
    return [(b, chunk, 0, ch.pack_arrays(short[i:j], np.packbits(many[i:j]))) for b, i, j in by_bucket(runs.bucket)]


def answer_seeds(bucket: int, rows: list) -> list:
    """One bit per seed asked for: does another document have it?"""
    asked = [ch.unpack_arrays(p, np.uint32, np.uint8) for _, _, p in rows]
    seeds = np.concatenate([a[0] for a in asked])
    many = np.concatenate([np.unpackbits(a[1], count=len(a[0])) for a in asked]).astype(bool)
    order = np.argsort(seeds, kind="stable")
    s = seeds[order]
    same = s[1:] == s[:-1]
    again = np.zeros(len(s), bool)
    again[1:] |= same
    again[:-1] |= same
    many[order] |= again
    out, at = [], 0
    for (src, _, _), (own, _) in zip(rows, asked):
        out.append((src, bucket, 1, ch.pack_arrays(np.packbits(many[at : at + len(own)]))))
        at += len(own)
    return out


def read_bits(rows: list, kind: int, layout: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """The answers of one kind, put back in the order in which the chunk asked."""
    answers = {src: p for k, src, p in rows if k == kind}
    out = np.zeros(n, bool)
    for b, i, j in layout:
        if b in answers:
            out[i:j] = np.unpackbits(ch.unpack_arrays(answers[b], np.uint8)[0], count=j - i).astype(bool)
    return out


@dataclass
class Contexts:
    """Distinct runs of candidate windows of a chunk, ordered by bucket."""

    run: np.ndarray  # an example run of each
    key: np.ndarray  # hash of its text
    low: np.ndarray  # smallest document id
    count: np.ndarray  # windows in it
    layout: list
    of: np.ndarray  # context of each candidate run
    candidates: np.ndarray  # runs


def contexts(units: Units, runs: Runs, repeated: np.ndarray, width: int) -> Contexts:
    """Candidate runs with the same text are kept once, with the smallest document id."""
    live = np.flatnonzero(repeated[runs.seed])
    first, count, seed = runs.first[live], runs.count[live], runs.seed[live]
    key = span_hashes(units, first, count + width - 1)
    order = np.lexsort((units.ids[runs.doc[live]], key, seed))
    o_key, o_seed = key[order], seed[order]
    new = np.ones(len(order), bool)
    new[1:] = (o_key[1:] != o_key[:-1]) | (o_seed[1:] != o_seed[:-1])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    head = order[new]  # the smallest id comes first within equals
    bucket = runs.bucket[seed][head]  # seeds are ordered by bucket already
    return Contexts(live[head], key[head], units.ids[runs.doc[live]][head], count[head], by_bucket(bucket), of, live)


def span_hashes(units: Units, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of each span of units."""
    n = int(units.bounds[-1])
    if not len(first):
        return np.zeros(0, U)
    up, down = kit.powers(n + 1)
    values = units.values(0, n) * up[:n]
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum(values, out=sums[1:])
    return kit.mix((sums[first + length] - sums[first]) * down[first] + length.astype(U) * U(0xD6E8FEB86659FD93))


def covered(n: int, first: np.ndarray, count: np.ndarray, later: np.ndarray, base: np.ndarray, bits: np.ndarray, width: int) -> np.ndarray:
    """Units that lie in a window which also starts in a document with a smaller id.

    Of each candidate run: its first window, its windows, whether this chunk has the same text under a smaller id, and
    where the answers for its windows begin.
    """
    edge = np.zeros(n + 1, np.int32)
    if len(first):
        total = int(count.sum())
        within = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        hit = bits[np.repeat(base, count) + within] | np.repeat(later, count)
        starts = (np.repeat(first, count) + within)[hit]
        # documents differ in the windows they have, never in two windows at one place
        edge[starts] += 1
        edge[starts + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def find_repeats(
    docs: DataFrame,
    text: str,
    units_of: Callable[[pa.Table], tuple[Units, object]],
    seed: int,
    width: int,
    prepare: Callable[[object], object],
    send: Callable[[object, np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]],
    resolve: Callable[[list[bytes]], list[np.ndarray]],
    finish: Callable[[pa.Table, Units, object, np.ndarray], pa.Table],
    schema: str,
    label: str,
) -> DataFrame:
    """Run the passes. ``prepare`` works on a chunk once, ``send`` lays out a slice of its runs for one bucket, ``resolve`` finds the
    repeats of one bucket. A chunk may send to every bucket, so ``send`` must not look at more than its runs."""
    packed = ch.chunked(docs, text, label)
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, -(-int(total) // ch.BUCKET_BYTES))

    def ask(chunk: int, payload: bytes) -> list:
        units, _ = units_of(ch.unpack_table(payload))
        return ask_seeds(chunk, seed_runs(units, seed, width, buckets), units.ids)

    def narrow(chunk: int, rows: list) -> list:
        units, extra = units_of(ch.unpack_table(next(p for _, k, p in rows if k == -1)))
        runs = seed_runs(units, seed, width, buckets)
        repeated = read_bits([(k, s, p) for s, k, p in rows], 1, by_bucket(runs.bucket), len(runs.unique))
        found = contexts(units, runs, repeated, width)
        out, ready = [], prepare(extra)
        for b, i, j in found.layout:
            run = found.run[i:j]
            sent = send(ready, runs.first[run], found.count[i:j], found.key[i:j])
            out.append((b, chunk, 2, ch.pack_arrays(found.low[i:j], found.count[i:j].astype(np.uint16), *sent)))
        # a note to itself, so that the last pass need not look for candidates again
        base = np.append(0, np.cumsum(found.count))
        layout = np.array([(b, base[i], base[j]) for b, i, j in found.layout], np.int64).reshape(-1, 3)
        later = units.ids[runs.doc[found.candidates]] > found.low[found.of]
        step = np.diff(runs.first[found.candidates], prepend=0)  # the runs are in order, and steps pack better than places
        note = ch.pack_arrays(layout, step.astype(np.int32), runs.count[found.candidates].astype(np.uint16), later, base[found.of].astype(np.int32))
        return [*out, (-1 - chunk, chunk, 4, note)]

    def decide(bucket: int, rows: list) -> list:
        if bucket < 0:
            return [(src, src, kind, p) for src, kind, p in rows]
        answers = resolve([p for _, _, p in rows])
        return [(src, bucket, 3, ch.pack_arrays(np.packbits(a))) for (src, _, _), a in zip(rows, answers)]

    def conclude(rows: list) -> pa.Table:
        table = ch.unpack_table(next(p for k, _, p in rows if k == -1))
        units, extra = units_of(table)
        layout, step, count, later, base = ch.unpack_arrays(next(p for k, _, p in rows if k == 4), np.int64, np.int32, np.uint16, bool, np.int32)
        layout = [tuple(x) for x in layout.reshape(-1, 3).tolist()]
        bits = read_bits(rows, 3, layout, layout[-1][2] if layout else 0)
        gone = covered(int(units.bounds[-1]), np.cumsum(step, dtype=np.int64), count.astype(np.int64), later, base.astype(np.int64), bits, width)
        return finish(table, units, extra, gone)

    asked = ch.each(packed, ask)
    seeds = materialize(ch.gathered(asked, answer_seeds), f"{label}-seeds", release=True)
    kept = ch.gathered(ch.as_messages(packed).unionByName(seeds), narrow)
    bits = materialize(ch.gathered(kept, decide), f"{label}-bits", release=True)
    return ch.concluded(ch.as_messages(packed).unionByName(bits), conclude, schema)
