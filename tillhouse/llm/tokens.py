"""Token ids as grammar-compressed shards, written as a table and read back.

Every shard holds whole documents in ascending id order. Re-Pair shortens its ids: the frequent pairs of neighbouring ids are
replaced by new symbols, again and again until none occurs ``LEAST`` times, however large the shard. The end of a document is a
symbol of its own (id 0 also stands inside texts), and no rule spans it. The rules, the length each symbol expands to and the
place of each document are stored, so a document, or any range of its ids, is decoded without the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.llm.chunks import pack_arrays, unpack_arrays
from tillhouse.llm.ship import ship_package
from tillhouse.session import scratch_path

END = 0
SHARD_TOKENS = 1 << 20
LEAST = 4  # occurrences at which a pair becomes a rule
_CACHED = 1 << 19
_TOGETHER = 1 << 19  # letters of the texts that are looked up together
_WIDE = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))  # fixed values: white space beyond ASCII
_DOT, _COMMA, _BETWEEN = "\x01", "\x02", "\x03"  # in place of a mark that is taken off its word, and between words


def _classes(*groups: bytes) -> np.ndarray:
    """For each byte the number of its group, from 1; 0 for all others."""
    table = np.zeros(256, np.uint8)
    for number, group in enumerate(groups, 1):
        table[list(group)] = number
    return table


_GAP, _ODD, _MARK = 1, 2, 3
_KIND = _classes(b" \n", b"\x01\x02\x03\t\x0b\x0c\r\x1c\x1d\x1e\x1f", b".,")
_LETTER = _classes(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") > 0


class Encoder:
    """Ids of texts as little-endian 32-bit integers, by the ``tokenizers`` library.

    A byte-level vocabulary splits a text before it merges bytes: no token joins a blank to the word before it, a single
    line feed stands alone, and a full stop or comma behind letters does too. So texts are taken apart there, the distinct
    words in between are looked up, and new ones are encoded together. A word is kept once, without the mark behind it,
    and ``cached`` words at most. A text that holds an added token of the vocabulary is encoded as it is.
    """

    def __init__(self, path: str, cached: int = _CACHED) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id: one letter of a token is one byte
        letters = set(ByteLevel.alphabet())
        for token, i in vocabulary.items():
            self.size[i] = len(token) if letters.issuperset(token) else 0
        self.cached = cached
        self.feed = self._encode("\n")
        # words behind a blank, without it; those at the start of a line, line feed included; marks that were taken off a word
        self.known: dict[str, bytes] = {"\n": self.feed, _DOT: self._encode("."), _COMMA: self._encode(",")}
        self.always = list(self.known)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode new words as one text and take its ids apart by their bytes."""
        if not words:
            return
        text = "".join([w if w[0] == "\n" else " " + w for w in words])
        codes = np.frombuffer(self._encode(text), "<u4")
        starts = np.flatnonzero(_KIND[np.frombuffer(text.encode(), np.uint8)] == _GAP)
        hi = np.searchsorted(np.cumsum(self.size[codes]), starts[1:]) + 1
        raw, cuts = codes.tobytes(), [0, *(4 * hi).tolist(), 4 * len(codes)]
        self.known.update(zip(words, [raw[i:j] for i, j in zip(cuts, cuts[1:])]))

    def forget(self) -> None:
        """Drop the words, so that a worker that waits holds the vocabulary only."""
        self.known = {w: self.known[w] for w in self.always}

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Ids of texts: distinct words are looked up once, then their ids are gathered for all places.

        Plain texts only: all white space is single blanks and line feeds between words. The others are encoded as they are.
        """
        parts = [t.encode() for t in texts]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        begin = np.cumsum(lengths) - lengths  # of the line feed put in front of each text
        buf = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8).copy()
        kinds = _KIND[buf]
        at = np.flatnonzero(kinds)
        kind = kinds[at]
        gap = kind == _GAP
        double = gap[:-1] & gap[1:] & (np.diff(at) == 1)
        bad = np.append(at[:-1][double], at[kind == _ODD])
        if len(bad):
            bad = set((np.searchsorted(begin, bad, side="right") - 1).tolist())
            good = [t for i, t in enumerate(texts) if i not in bad]
            codes_of = iter(self._by_words(good) if good else [])
            return [self._encode(t) if i in bad else next(codes_of) for i, t in enumerate(texts)]

        # a word starts with the blank or line feed in front of it; a full stop or comma that ends a word of letters is one of its own
        mark = at[kind == _MARK]
        alone = _LETTER[buf[mark - 1]] & (kinds[mark + 1] == _GAP)
        gap[kind == _MARK] = alone
        starts = at[gap][:-1]
        mark = mark[alone]
        buf[mark] = np.where(buf[mark] == ord("."), ord(_DOT), ord(_COMMA))
        offsets = np.append(starts, len(buf) - 1).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buf)).dictionary_encode()
        place = words.indices.to_numpy()
        one = pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary.cast(pa.string()))
        # quicker than one object per word from Arrow; the first word has a line feed, the others lose the blank in front
        distinct = pc.binary_join(one, _BETWEEN)[0].as_py().replace(_BETWEEN + " ", _BETWEEN).split(_BETWEEN)
        if len(self.known) > self.cached:  # the oldest half holds the frequent words
            for w in list(self.known)[self.cached // 2 :]:
                del self.known[w]
        found = list(map(self.known.get, distinct))
        new = [i for i, code in enumerate(found) if code is None]
        self._learn([distinct[i] for i in new])
        for i in new:
            found[i] = self.known[distinct[i]]
        codes = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = (np.cumsum(sizes) - sizes)[place]
        sizes = sizes[place]
        ends = np.cumsum(sizes)
        short = np.int32 if max(int(ends[-1]), len(codes)) < 1 << 31 else np.int64
        gather = np.repeat((first - ends + sizes).astype(short), sizes)
        gather += np.arange(len(gather), dtype=short)
        raw = codes[gather].tobytes()
        cuts = [*(4 * (ends - sizes)[np.searchsorted(starts, begin)]).tolist(), len(raw)]
        return [raw[i + len(self.feed) : j] for i, j in zip(cuts, cuts[1:])]  # without the line feed put in front

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        held: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if any(a in t for a in self.added) or not t.isascii() and any(c in t for c in _WIDE):
                out[i] = self._encode(t)
                continue
            held.append(i)
            size += len(t)
            if size > _TOGETHER:
                for j, code in zip(held, self._by_words([texts[j] for j in held])):
                    out[j] = code
                held, size = [], 0
        if held:
            for j, code in zip(held, self._by_words([texts[j] for j in held])):
                out[j] = code
        return out


@lru_cache(maxsize=2)
def encoder(path: str, cached: int = _CACHED) -> Encoder:
    return Encoder(path, cached)


def _slots(pairs: np.ndarray, bits: int) -> np.ndarray:
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int32)


def repair(ids: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Grammar of ``ids``: the shortened sequence, the rules, the length each rule expands to, and the first rule's symbol.

    The ids at the places ``ends`` become the symbol before the first rule's; no pair holds it. Every round replaces all pairs
    that occur ``least`` times at its start; where two overlap, the first in a row of them wins.
    """
    s = ids.astype(np.uint32)
    end = np.uint32(int(s.max()) + 1 if len(s) else 0)
    s[ends] = end
    base = int(end) + 1
    rules, lengths = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.int64)]
    made = 0
    at = np.flatnonzero((s[:-1] != end) & (s[1:] != end))
    pairs = ((s[:-1].astype(np.uint64) << np.uint64(32)) | s[1:])[at]
    while len(at):
        ordered = np.sort(pairs)
        head = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        chosen = ordered[head[np.diff(np.append(head, len(ordered))) >= least]]
        if not len(chosen):
            break
        # pairs find their rule by a slot; of the rules that share a slot one has it, and pairs of the others are searched for
        bits = min(max((16 * len(chosen)).bit_length(), 10), 20)
        own, rules_made = _slots(chosen, bits), np.arange(len(chosen), dtype=np.int32)
        in_slot = np.zeros(1 << bits, np.int32)
        in_slot[own] = rules_made
        slot = _slots(pairs, bits)
        rule = in_slot[slot]
        hit = chosen[rule] == pairs
        lost = own[in_slot[own] != rules_made]
        if len(lost):
            shared = np.zeros(1 << bits, bool)
            shared[lost] = True
            other = np.flatnonzero(~hit)
            other = other[shared[slot[other]]]
            rule[other] = np.minimum(np.searchsorted(chosen, pairs[other]), len(chosen) - 1)
            hit[other] = chosen[rule[other]] == pairs[other]
        at, rule = at[hit], rule[hit]
        place = np.arange(len(at), dtype=np.int32)
        row = np.append(True, np.diff(at) != 1)
        take = (place - np.maximum.accumulate(np.where(row, place, 0))) % 2 == 0  # every other one of those in a row
        at, rule = at[take], rule[take].astype(np.int64)
        left, right = (chosen >> np.uint64(32)).astype(np.uint32), (chosen & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        known = np.concatenate(lengths)
        size = lambda x: np.where(x < base, 1, known[np.maximum(x.astype(np.int64) - base, 0)] if len(known) else 1)
        rules.append(np.stack([left, right], axis=1))
        lengths.append(size(left) + size(right))
        s[at] = (base + made + rule).astype(np.uint32)
        made += len(chosen)
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s = s[keep]
        # every chosen pair is replaced or broken up by now, and the others only became rarer: next come pairs with a new symbol
        new = at - np.arange(len(at))
        touched = np.zeros(len(s) + 1, bool)
        touched[new] = True
        touched[new - 1] = True  # a symbol at the start marks the spare last place
        at = np.flatnonzero(touched[: len(s) - 1])
        at = at[(s[at] != end) & (s[at + 1] != end)]
        pairs = (s[at].astype(np.uint64) << np.uint64(32)) | s[at + 1]
    return s, np.concatenate(rules), np.concatenate(lengths), base


def expand(s: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    """The ids that a sequence of symbols stands for. Lengths say where each ends up, so every rule is opened once."""
    s = s.astype(np.uint32)
    size = symbol_lengths(s, lengths, base)
    place = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint32)
    own = np.concatenate((np.ones(1, np.int64), lengths.astype(np.int64)))
    left, right = rules[:, 0].astype(np.uint32), rules[:, 1].astype(np.uint32)
    behind = own[np.maximum(left.astype(np.int64) - base + 1, 0)]  # how far the second part of a rule lies behind the first
    while len(s):
        made = s >= base
        out[place[~made]] = s[~made]
        rule, place = (s[made] - np.uint32(base)).astype(np.int64), place[made]
        s = np.concatenate((left[rule], right[rule]))
        place = np.concatenate((place, place + behind[rule]))
    return out


def symbol_lengths(s: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """How many ids each symbol stands for."""
    return np.concatenate((np.ones(1, np.int64), lengths.astype(np.int64)))[np.maximum(s.astype(np.int64) - base + 1, 0)]


def pack_shard(doc_ids: list, encoded: list[bytes]) -> bytes:
    """One shard: document ids, ids per document, place of each document among the symbols, rules, lengths, symbols."""
    ids = np.frombuffer(b"".join(encoded), "<u4")
    n = np.array([len(e) // 4 for e in encoded], np.int64)
    s, rules, lengths, base = repair(ids, np.cumsum(n) - 1)
    small = np.uint16 if base + len(rules) <= 1 << 16 else np.uint32
    places = np.searchsorted(np.cumsum(symbol_lengths(s, lengths, base)), np.cumsum(n) - n, side="right")
    return pack_arrays(
        np.array([d is not None for d in doc_ids], bool),
        np.array([0 if d is None else d for d in doc_ids], np.int64),
        n,
        places.astype(np.int64),
        np.array([base, small().itemsize], np.int64),
        rules.astype(small),
        lengths.astype(np.uint32),
        s.astype(small),
    )


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, payload: bytes) -> None:
        self.has_id, self.doc_ids, self.n_tokens, self.places, meta, *_ = unpack_arrays(payload, bool, np.int64, np.int64, np.int64, np.int64)
        self.base = int(meta[0])
        kind = np.uint16 if meta[1] == 2 else np.uint32
        rules, self.lengths, self.symbols = unpack_arrays(payload, bool, np.int64, np.int64, np.int64, np.int64, kind, np.uint32, kind)[5:]
        self.rules = rules.reshape(-1, 2)

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        out = expand(symbols, self.rules, self.base, self.lengths)
        out[out == self.base - 1] = END
        return out

    def _symbols(self, i: int) -> np.ndarray:
        end = self.places[i + 1] if i + 1 < len(self.places) else len(self.symbols)
        return self.symbols[self.places[i] : end]

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i``, its end included."""
        return self._ids(self._symbols(i))

    def part(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``i``: only the symbols that stand for them are expanded."""
        symbols = self._symbols(i)
        ends = np.cumsum(symbol_lengths(symbols, self.lengths, self.base))
        start, stop = max(start, 0), min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        lo, hi = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop, side="left")) + 1
        before = int(ends[lo - 1]) if lo else 0
        return self._ids(symbols[lo:hi])[start - before : stop - before]

    def documents(self) -> np.ndarray:
        return self._ids(self.symbols)


def write_shards(docs: DataFrame, tokenizer: str, path: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode every text (null: empty), end it with id 0 and write shards in ascending id order (null first; ties by text).

    The table at ``path`` has ``part, block`` (their order is the documents' order), ``n_ids`` and ``payload``.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer)
        end = np.array([END], "<u4").tobytes()
        ids: list = []
        held: list[bytes] = []
        size = 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([block]), pa.array([size]), pa.array([pack_shard(ids, held)], pa.binary())], names=["part", "block", "n_ids", "payload"])

        for batch in batches:
            for at in range(0, len(batch), 2048):
                piece = batch.slice(at, 2048)
                codes = encode([t or "" for t in piece.column("text").to_pylist()])
                for d, code in zip(piece.column("doc_id").to_pylist(), codes):
                    n = len(code) // 4 + 1
                    if size and size + n > SHARD_TOKENS:
                        yield flush()
                        ids, held, size, block = [], [], 0, block + 1
                    ids.append(d)
                    held.append(code + end)
                    size += n
        if held:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows.mapInArrow(run, "part long, block long, n_ids long, payload binary").write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shards at ``path``."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, payload in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), batch.column("payload")):
                shard = Shard(payload.as_py())
                ids = shard.documents().astype("<u4", copy=False)
                ends = np.cumsum(shard.n_tokens)
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * (e - n) : 4 * e]) for n, e in zip(shard.n_tokens.tolist(), ends.tolist())]
                count = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * count, pa.int64()),
                        pa.array([block] * count, pa.int64()),
                        pa.array(shard.doc_ids, mask=~shard.has_id),
                        pa.array(ends - shard.n_tokens),
                        pa.array(shard.n_tokens),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "block", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    stored = spark.read.schema("part long, block long, n_ids long, payload binary").parquet(path)
    docs = stored.select("part", "block", "payload").mapInArrow(run, "part long, block long, doc_id long, inner long, n_tokens long, ids_crc32 long")
    sizes = stored.select("part", "block", "n_ids")
    # one row per range partition, then the blocks of each partition
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    first = sizes.select("part", "block", within.alias("within")).join(parts, "part").select("part", "block", (F.col("before") + F.col("within")).alias("first"))
    return docs.join(first, ["part", "block"]).select("doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", path: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` (to ``path``, else a scratch folder) and return what reading them gives.

    Null and empty texts are the end id alone. Repeated rows are documents of their own. A null id sorts first.
    """
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_shards(docs, tokenizer, path, text, doc_id)
    return read_shards(docs.sparkSession, path)
