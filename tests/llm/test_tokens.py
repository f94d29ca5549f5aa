"""Token shards and packing: exact round trips and the library's own encoding."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillhouse.llm import packing, tokens
from tillhouse.llm.queries import QUERIES, tokenizer_path

PATH = tokenizer_path()
SF = "/root/testdata/sf0.001"


def plain(texts):
    t = Tokenizer.from_file(PATH)
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_encoder_equals_the_library():
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "ß", "1", ".", " ", " ", "\n", ",", "'", "s", "\t", " the", "_", "漢", "🙂", "\u00a0", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["x" * 5000, "word " * 3000]
    encode = tokens.Encoder(PATH)
    for i in range(0, len(texts), 700):
        assert encode(texts[i : i + 700]) == plain(texts[i : i + 700])


def test_words_are_kept_without_the_mark_behind_them():
    texts = ["stone, water. stone.\nwater, it's. a-b. 3.", "\x01. stone \x01.", "b.. ., water"]
    encode = tokens.Encoder(PATH)
    assert encode(texts) == plain(texts)
    assert {"stone", "water", "it's", "a-b"} <= set(encode.known)
    assert not {"stone,", "stone.", "water.", "\nwater,", "it's."} & set(encode.known)


def test_few_words_are_held_when_few_are_asked_for():
    texts = [f"w{i} v{i}, common" for i in range(400)]
    encode = tokens.Encoder(PATH, 100)
    for i in range(0, 400, 20):
        assert encode(texts[i : i + 20]) == plain(texts[i : i + 20])
    assert len(encode.known) < 200


def test_a_special_token_in_a_text_is_what_the_library_makes_of_it():
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "plain words here", "hello <|endoftext|> world, and more words"]
    encode = tokens.Encoder(PATH)
    assert encode.added and encode(texts) == plain(texts)


def test_white_space_and_control_bytes_are_what_the_library_makes_of_them():
    odd = ["\x01", "\x02.", "a\x03b", "\x85", "\u2003", "\u3000", "\x1c", "\r\n", "\n\n", " \n", "  ", ". ", "é. ", "e, ", ",\n", ".", "\ta"]
    texts = [f"{a}word. {b}more, é{c}" for a in odd for b in odd for c in odd] + ["", " ", "\n", ".", "end.", "end. "]
    encode = tokens.Encoder(PATH)
    assert encode(texts) == plain(texts)
    assert encode(texts[-6:]) == plain(texts[-6:])


def test_a_round_of_few_pairs_takes_small_tables():
    ids = np.random.default_rng(2).integers(0, 40, 3000).astype("<u4")
    ends = np.array([1500, 2999])
    tokens.repair(ids, ends)
    tracemalloc.start()
    symbols, rules, lengths, base = tokens.repair(ids, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rules) and peak < 1 << 20


def test_grammar_round_trip_and_random_access():
    """Ids 0 stand inside documents as well as at their ends."""
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(0, 6, rng.integers(0, 400)), 0).astype("<u4") for _ in range(300)]
    docs[5], docs[6] = np.array([0], "<u4"), np.array([0, 0, 0], "<u4")
    ids = np.concatenate(docs)
    ends = np.cumsum([len(d) for d in docs]) - 1
    symbols, rules, lengths, base = tokens.repair(ids, ends)
    assert len(rules) and len(symbols) < len(ids) / 2
    whole = tokens.expand(symbols, rules, base, lengths)
    assert (np.flatnonzero(whole == base - 1) == ends).all()
    assert (np.where(whole == base - 1, 0, whole) == ids).all()
    for k in range(len(rules)):
        assert len(tokens.expand(np.array([base + k]), rules, base, lengths)) == lengths[k]
    pairs = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
    pairs = pairs[(symbols[:-1] != base - 1) & (symbols[1:] != base - 1) & (symbols[:-1] != symbols[1:])]
    assert np.unique(pairs, return_counts=True)[1].max() < tokens.LEAST  # no pair is left that would make a rule
    shard = tokens.Shard(tokens.pack_shard(list(range(300)), [d.tobytes() for d in docs]))
    for i in range(300):
        assert (shard.document(i) == docs[i]).all()
        lo, hi = sorted(rng.integers(0, len(docs[i]) + 2, 2).tolist())
        assert (shard.part(i, lo, hi) == docs[i][lo:hi]).all()
    assert (shard.documents() == ids).all()


def test_exclamation_marks_do_not_end_documents():
    texts = ["wow! that", "second doc", "third", "!", "", "!!! no! end!"]
    codes = [c + b"\0\0\0\0" for c in plain(texts)]
    assert b"\0\0\0\0" in codes[0][:-4]  # the mark is id 0
    shard = tokens.Shard(tokens.pack_shard(list(range(len(texts))), codes))
    assert [shard.document(i).astype("<u4").tobytes() for i in range(len(texts))] == codes


def test_documents_of_a_table_by_random_access(spark, tmp_path):
    """Every document of the table, read alone from its shard, has the library's ids."""
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    tokens.write_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH, str(tmp_path / "shards"))
    want = dict(zip([d for d, _ in rows], [c + b"\0\0\0\0" for c in plain([t for _, t in rows])]))
    seen = 0
    for r in spark.read.parquet(str(tmp_path / "shards")).collect():
        shard = tokens.Shard(bytes(r["payload"]))
        for i, d in enumerate(shard.doc_ids.tolist()):
            assert shard.document(i).astype("<u4").tobytes() == want[d]
            seen += 1
    assert seen == len(rows)


def test_a_passage_is_compressed_in_a_full_shard():
    """The rule for stopping does not depend on the size of the shard."""
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 50_000, tokens.SHARD_TOKENS).astype(np.uint32)
    passage = rng.integers(0, 50_000, 300).astype(np.uint32)
    for at in range(400):
        ids[at * 2600 : at * 2600 + 300] = passage
    symbols, rules, lengths, base = tokens.repair(ids, np.array([len(ids) - 1]))
    assert len(symbols) < len(ids) - 400 * 280 and lengths.max() > 64


def rows_of(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_token_query(spark):
    rows, at, want = sorted(rows_of(spark)), 0, []
    for (d, _), code in zip(rows, plain([t for _, t in rows])):
        code += b"\0\0\0\0"
        want.append((d, at, len(code) // 4, zlib.crc32(code)))
        at += len(code) // 4
    assert sorted(map(tuple, QUERIES["op5_token_output"](spark, SF).collect())) == want


def check_packing(rows, got, capacity):
    encoded = dict(zip([d for d, _ in rows], [c + b"\0\0\0\0" for c in plain([t for _, t in rows])]))
    sequences, pieces = {}, {}
    for doc_id, piece, start, length, crc, sequence, offset in got:
        assert zlib.crc32(encoded[doc_id][4 * start : 4 * (start + length)]) == crc
        pieces.setdefault(doc_id, []).append((piece, start, length))
        sequences.setdefault(sequence, []).append((offset, length))
    for doc_id, code in encoded.items():
        at = 0
        own = sorted(pieces[doc_id])
        for k, (piece, start, length) in enumerate(own):
            assert (piece, start) == (k, at) and (k == 0 or length == capacity)
            at += length
        assert at == len(code) // 4 and (len(own) == 1 or at > capacity)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(len(c) // 4 for c in encoded.values())


def test_packing_query(spark):
    used, total = check_packing(rows_of(spark), map(tuple, QUERIES["op6_packing"](spark, SF).collect()), 2048)
    assert used <= -(-total // 2048) * 1.02 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    for _ in range(40):
        counts = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 12))}
        ranks, places = {}, {}
        for length, rank, many, first, offset in packing.best_fit(counts, 30):
            for k in range(many):
                ranks.setdefault(length, []).append(rank + k)
                places.setdefault(first + k, []).append((offset, length))
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        bins = []
        for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fits = [(gap, i) for i, gap in enumerate(bins) if gap >= length]
            if fits:
                bins[min(fits)[1]] -= length
            else:
                bins.append(30 - length)
        assert len(places) == len(bins)


def test_edge_rows(docs, spark):
    rows = [(3, None), (1, ""), (2, "a b"), (2, "a b"), (None, "z"), (4, "word " * 5000)]
    got = tokens.tokenized(docs(rows), PATH).collect()
    assert len(got) == 6 and {r["doc_id"]: r["n_tokens"] for r in got}[3] == 1
    assert sorted(r["start"] for r in got)[0] == 0 and [r["start"] for r in got if r["doc_id"] is None] == [0]
    packed = packing.pack(docs(rows), PATH).collect()
    assert sum(r["length"] for r in packed) == sum(r["n_tokens"] for r in got)
    assert tokens.tokenized(docs([]), PATH).collect() == [] and packing.pack(docs([]), PATH).collect() == []
