"""Phrases whose words stand together more often than their parts make likely, level by level.

1. All words are counted. Those that occur ``least`` times are the candidates of level one.
2. Level ``k`` scans the texts with a bit table of the level below: where two overlapping candidates of ``k - 1`` words follow each other,
   their union may be frequent. Such phrases are tallied per slice of text and added up in Spark; what reaches ``least`` is a
   candidate. The bit table has a fixed size and may let more through, never less (a phrase cannot be more frequent than its parts).
3. The candidates go into double-array tries of about ``PART_PHRASES`` phrases, and ``TOGETHER`` of them are broadcast for one scan of the
   texts. All positions of a text advance through a trie together, one word a level; accepting states are counted with
   bincount, and the counts of all tasks are added up in ranges.
4. Scores, the cut with the lowest score, and containment in longer phrases are joins and aggregates over the counted phrases.

Words go by 64-bit hashes of language and word. Step 1 compares the texts that the tasks have met under a hash; if two differ,
it starts again with another hash function.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm import textkit as kit
from tillhouse.llm.ship import ship_package
from tillhouse.llm.trie import Trie
from tillhouse.session import materialize

U = np.uint64
SLICE = 2 << 20  # bytes of text looked at together
PART_PHRASES = 1 << 18  # in one trie
TOGETHER = 4  # tries that one scan of the texts follows
RANGE = 1 << 16  # phrase counts that are added up together
BITS = 27  # of the bit table's index
HELD_WORDS = 1 << 19  # distinct words a task holds before it passes their counts on
_BREAKS = b".,;:!?\n\x0b\x0c\r"


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    breaks = np.zeros(256, bool)
    breaks[list(_BREAKS)] = True
    gap = breaks.copy()
    gap[[32, 9]] = True
    return breaks, gap


@lru_cache(maxsize=2)
def _byte_values(seed: int) -> np.ndarray:
    values = np.random.default_rng([seed, 11]).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
    values[65:91] = values[97:123]
    return values


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each word with A-Z as a-z, in slices of bounded size."""
    out = np.empty(len(starts), U)
    values, lo = _byte_values(seed), 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20))))
        total = U(0)
        if hi == lo + 1:  # perhaps a very long word: block by block
            up, _ = kit.powers(1 << 20)
            base, power = int(up[1]), 1
            for at in range(int(starts[lo]), int(ends[lo]), 1 << 20):
                part = values[buf[at : min(at + (1 << 20), int(ends[lo]))]]
                total = U((int(total) + power * int((part * up[: len(part)]).sum(dtype=U))) & 0xFFFFFFFFFFFFFFFF)
                power = power * pow(base, 1 << 20, 1 << 64) & 0xFFFFFFFFFFFFFFFF
            out[lo] = total
        else:
            a, b = int(starts[lo]), int(ends[hi - 1])
            up, down = kit.powers(b - a + 1)
            sums = np.zeros(b - a + 1, U)
            np.cumsum(values[buf[a:b]] * up[: b - a], out=sums[1:])
            out[lo:hi] = (sums[ends[lo:hi] - a] - sums[starts[lo:hi] - a]) * down[starts[lo:hi] - a]
        lo = hi
    out += (ends - starts).astype(U) * U(0xD6E8FEB86659FD93)
    return kit.mix(out)


def _language(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


class Words:
    """The words of a slice: hashes (of language and word), the piece each stands in, and their texts."""

    def __init__(self, texts: pa.ChunkedArray, langs: list[str], seed: int):
        breaks, gap = _tables()
        self.buf, bounds = kit.joined(texts, separator=True)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap[self.buf], [True])).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(breaks[self.buf]), self.starts)
        self.doc = np.searchsorted(bounds, self.starts, side="right") - 1
        names = np.array([_language(x) for x in langs], U)
        self.hashes = word_hashes(self.buf, self.starts, self.ends, seed)
        self.hashes ^= names[self.doc]
        kit.mix(self.hashes)

    def text(self, i: int) -> str:
        return self.buf[self.starts[i] : self.ends[i]].tobytes().lower().decode()


def slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of about ``SLICE`` bytes of whole texts at a time; a longer text is a slice of its own."""
    for batch in batches:
        texts, langs = batch.column("text"), [x or "und" if x is None else x for x in batch.column("lang").to_pylist()]
        size = np.cumsum(pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(batch):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SLICE, side="right")))
            yield Words(pa.chunked_array([texts.slice(lo, hi - lo)]), langs[lo:hi], seed), langs[lo:hi]
            lo = hi


def grams(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all its words but the last, and that of the last."""
    return kit.mix(g * U(0x9E3779B97F4A7C15) + h)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def counted_words(docs: DataFrame, seed: int) -> DataFrame:
    """``h, lang, word, n`` of every word of every language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, texts, of = np.empty(0, U), np.empty(0, np.int64), np.empty(0, object), np.empty(0, object)

        def out():
            return pa.RecordBatch.from_arrays([_longs(held), pa.array(of, pa.string()), pa.array(texts, pa.string()), pa.array(n)], names=["h", "lang", "word", "n"])

        for words, langs in slices(batches, seed):
            u, first, c = np.unique(words.hashes, return_index=True, return_counts=True)
            if not len(u):
                continue
            at = np.searchsorted(held, u)
            known = np.zeros(len(u), bool)
            known[at < len(held)] = held[at[at < len(held)]] == u[at < len(held)]
            n[at[known]] += c[known]
            new = np.flatnonzero(~known)
            more, names = np.empty(len(new), object), np.empty(len(new), object)
            more[:] = [words.text(i) for i in first[new].tolist()]
            names[:] = [langs[d] for d in words.doc[first[new]].tolist()]
            order = np.argsort(np.concatenate((held, u[new])), kind="stable")
            held, n = np.concatenate((held, u[new]))[order], np.concatenate((n, c[new]))[order]
            texts, of = np.concatenate((texts, more))[order], np.concatenate((of, names))[order]
            if len(held) > HELD_WORDS:
                yield out()
                held, n, texts, of = held[:0], n[:0], texts[:0], of[:0]
        if len(held):
            yield out()

    rows = docs.mapInArrow(run, "h long, lang string, word string, n long")
    return rows.repartition("h").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))


def bit_table(hashes: DataFrame) -> np.ndarray:
    """One bit per upper ``BITS`` bits of the column ``g``: a table of fixed size."""
    low = BITS - 15

    def pack(group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << low, bool)
        bits[group["bit"].to_numpy() & ((1 << low) - 1)] = True
        return pa.table({"part": group["part"].slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    bit = F.shiftrightunsigned("g", 64 - BITS)
    rows = hashes.select(bit.cast("int").alias("bit")).distinct().withColumn("part", F.shiftright("bit", low))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    width = (1 << low) // 8
    for r in rows.groupBy("part").applyInArrow(pack, "part int, bits binary").collect():
        out[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def _in_table(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    at = (g >> U(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def candidates(docs: DataFrame, seed: int, tables: list, least: int) -> DataFrame:
    """``path``: phrases of one word more than there are ``tables``, whose parts are candidates and which occur ``least`` times or more."""
    k = len(tables) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in slices(batches, seed):
            h, piece, n = words.hashes, words.piece, len(words.hashes) - k + 1
            if n <= 0:
                continue
            g, open_ = h, np.ones(len(h), bool)
            for j, table in enumerate(tables):
                if j:
                    g = grams(g[:-1], h[j:])
                    open_ = open_[:-1] & open_[1:]
                open_ &= _in_table(table.value, g)
            at = np.flatnonzero(open_[:-1] & open_[1:] & (piece[k - 1 :] == piece[:n]))
            if not len(at):
                continue
            number = np.unique(h, return_inverse=True)[1].astype(np.int64)
            own = number[at]
            for j in range(1, k):
                key, first, own, count = np.unique((own << 32) | number[at + j], return_index=True, return_inverse=True, return_counts=True)
            first = at[first]
            yield pa.RecordBatch.from_arrays([*(_longs(h[first + j]) for j in range(k)), pa.array(np.minimum(count, least).astype(np.int32))], names=[*(f"h{j}" for j in range(k)), "n"])

    keys = [f"h{j}" for j in range(k)]
    rows = docs.mapInArrow(run, ", ".join(f"{x} long" for x in keys) + ", n int")
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") >= least).select(F.array(*keys).alias("path"))


def path_hashes(paths: DataFrame) -> DataFrame:
    """``g``: the hash of each phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("path")
            if not len(column):
                continue
            h = column.flatten().to_numpy().view(U).reshape(len(column), -1)
            g = h[:, 0].copy()
            for j in range(1, h.shape[1]):
                g = grams(g, h[:, j])
            yield pa.RecordBatch.from_arrays([_longs(g)], names=["g"])

    return paths.mapInArrow(run, "g long")


def built(phrases: DataFrame, longest: int) -> tuple[Trie, np.ndarray]:
    """The trie of one part (``key, path``), and the key of each phrase in it."""
    table = phrases.select("key", "path").toArrow()
    column = table["path"].combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    paths = np.zeros((len(lengths), longest), U)
    paths[np.arange(longest) < lengths[:, None]] = column.flatten().to_numpy().view(U)
    return Trie(paths, lengths), table["key"].to_numpy()


def counted(docs: DataFrame, seed: int, parts: list[DataFrame], longest: int) -> DataFrame:
    """``key, n``: how often each phrase of some parts occurs, in one scan."""
    sent, sizes = [], []
    for part in parts:
        trie, keys = built(part, longest)
        sizes.append(len(keys))
        sent.append(docs.sparkSession.sparkContext.broadcast((trie, keys)))
        del trie, keys  # the driver holds one trie at a time
    width = max(-(-n // RANGE) for n in sizes) + 1  # numbers of ranges per trie

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(n, np.int64) for n in sizes]
        for words, _ in slices(batches, seed):
            hashes, number = np.unique(words.hashes, return_inverse=True)
            for trie, count in zip(sent, counts):
                for found in trie.value[0].follow(hashes, number, words.piece):
                    count += np.bincount(found, minlength=len(count))
        for t, count in enumerate(counts):
            for r in range(0, len(count), RANGE):
                part = count[r : r + RANGE]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([t * width + r // RANGE], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["range", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def out():
            lo = at % width * RANGE
            return pa.RecordBatch.from_arrays([pa.array(sent[at // width].value[1][lo : lo + len(total)]), pa.array(total)], names=["key", "n"])

        for batch in batches:
            for r, part in zip(batch.column("range").to_pylist(), batch.column("counts")):
                own = np.frombuffer(part.as_buffer(), np.int64)
                if r != at:
                    if at is not None:
                        yield out()
                    at, total = r, np.zeros(len(own), np.int64)
                total += own
        if at is not None:
            yield out()

    return docs.mapInArrow(run, "range int, counts binary").repartition("range").sortWithinPartitions("range").mapInArrow(add, "key long, n long")


def scored(phrases: DataFrame, words: DataFrame, scale: int) -> DataFrame:
    """``path, a, l, r, score`` of each phrase, from the cut with the lowest score (ties: the shortest first part)."""
    counts = phrases.select("path", "n").unionByName(words.select(F.array("h").alias("path"), "n"))
    cuts = phrases.select("path", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("path", F.lit(1), F.col("k"))).withColumn("rest", F.slice("path", F.col("k") + 1, F.size("path") - F.col("k")))
    cuts = cuts.join(counts.select(F.col("path").alias("first"), F.col("n").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("path").alias("rest"), F.col("n").alias("r")), "rest")
    score = F.expr(f"(cast({scale} as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    cuts = cuts.select("path", "a", score.alias("score"), "k", "l", "r")
    best = cuts.groupBy("path", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return best.select("path", "a", "m.l", "m.r", "m.score")


def uncovered(phrases: DataFrame, percent: int) -> DataFrame:
    """``path`` of the phrases that no longer phrase with ``percent`` of their occurrences contains."""
    starts = F.sequence(F.lit(0), F.size("path") - 2)
    # all contiguous parts of two words or more that are shorter than the phrase itself
    parts = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(2), F.size("path") - i), lambda m: F.slice("path", i + 1, m))))
    inner = phrases.where(F.size("path") > 2).select(F.col("path").alias("whole"), "n", F.explode(F.array_distinct(parts)).alias("path"))
    most = inner.where(F.size("path") < F.size("whole")).groupBy("path").agg(F.max("n").alias("most"))
    both = phrases.join(most, "path", "left")
    return both.where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("n"))).select("path")


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000, scale: int = 1_000_000, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two to ``longest`` words of each language.

    ``a`` counts the phrase (A-Z as a-z) inside pieces between ``. , ; : ! ?`` and line or page breaks, overlaps included. A phrase that
    occurs ``least`` times is a candidate. Cut after its first words, it has ``l`` and ``r`` occurrences of both sides and the score
    ``floor(scale * a * a / (l * r))``; its lowest score counts. Candidates that stand inside a longer candidate with
    ``percent`` of their occurrences are dropped. The rest is ordered by score, ``a`` and phrase. ``n`` counts the words of the language.

    A null language is ``und``; null and empty texts have no words. Repeated rows count each. Without candidates the result
    is empty. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    seed = 0
    while True:
        words = materialize(counted_words(texts, seed), "words")
        if words.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").isEmpty():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    frequent = materialize(words.where(F.col("n") >= least), "frequent")
    tables, levels = [], []
    seen = frequent.select(F.col("h").alias("g"))
    for k in range(2, longest + 1):
        tables.append(spark.sparkContext.broadcast(bit_table(seen)))
        level = materialize(candidates(texts, seed, tables, least), f"level-{k}")
        levels.append(level)
        seen = path_hashes(level)
    paths = levels[0]
    for level in levels[1:]:
        paths = paths.unionByName(level)
    total = paths.count()
    schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    if not total:
        return spark.createDataFrame([], schema)
    parts = -(-total // PART_PHRASES) + (total > PART_PHRASES)  # one more, as parts by hash differ in size
    paths = materialize(paths.select(F.monotonically_increasing_id().alias("key"), "path", F.pmod(F.xxhash64("path"), F.lit(parts)).alias("part")), "paths")
    found = None
    for p in range(0, parts, TOGETHER):
        own = [paths.where(F.col("part") == i) for i in range(p, min(p + TOGETHER, parts))]
        own = materialize(counted(texts, seed, own, longest), f"counts-{p}")
        found = own if found is None else found.unionByName(own)
    phrases = materialize(paths.join(found, "key").where(F.col("n") >= least).select("path", "n"), "phrases")
    left = scored(phrases, frequent, scale).join(uncovered(phrases, percent), "path")
    of = frequent.select(F.col("h").alias("_h"), "lang")
    left = left.join(of, F.col("path")[0] == F.col("_h")).drop("_h")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    left = left.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place")
    left = materialize(left, "finalists")
    spelled = left.select("path", F.posexplode("path").alias("at", "h")).join(frequent.select("h", "word"), "h")
    spelled = spelled.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    left = left.join(spelled, "path").withColumn("phrase", F.array_join(F.col("spelled.word"), " ")).join(F.broadcast(totals), "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
