"""Substring deduplication over bytes by suffix arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import textkit as kit
from tillhouse.llm.chunks import unpack_arrays
from tillhouse.llm.induced import common_prefixes, suffix_array
from tillhouse.llm.repeats import Units, document_ids, find_repeats, span_hashes

WIDTH = 50
SEED = 24
COMPARED = 1 << 20  # bytes of spans that are compared at once
HASHED = 1 << 17  # bytes of spans that are hashed at once


def byte_units(table: pa.Table, text: str, doc_id: str) -> tuple[Units, np.ndarray]:
    buf, bounds = kit.joined(table[text])
    values = kit.byte_values()
    return Units(lambda lo, hi: values[buf[lo:hi]], bounds, document_ids(table[doc_id])), buf


def spans(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of all units of the given spans, one span after the other."""
    total = int(length.sum())
    kind = np.int32 if total < 1 << 31 and (not len(first) or int((first + length).max()) < 1 << 31) else np.int64
    return np.arange(total, dtype=kind) + np.repeat((first - (np.cumsum(length) - length)).astype(kind), length)


def array_repeats(payloads: list[bytes], width: int) -> list[np.ndarray]:
    """For each window sent: is there a smaller document with the same bytes?

    Spans with the same bytes are looked at once. The bytes of the others make one string (symbol 0 after each
    span). Its suffix array puts equal windows side by side, and the common prefixes tell where a group of equal
    windows ends; the smallest document id of a group decides.
    """
    parts = [unpack_arrays(p, np.int64, np.uint16, np.uint8) for p in payloads]
    low = np.concatenate([p[0] for p in parts])
    count = np.concatenate([p[1] for p in parts]).astype(np.int64)
    raw = np.concatenate([p[2] for p in parts])
    length = count + width - 1
    span_of = same_spans(hashes_of(raw, length), raw, length, width)
    chosen, of = np.unique(span_of, return_inverse=True)
    least_id = np.full(len(chosen), np.iinfo(np.int64).max)
    np.minimum.at(least_id, of, low)

    size = length[chosen]
    at = np.cumsum(size + 1) - size - 1
    text = np.zeros(int(size.sum()) + len(size), np.uint8)
    text[spans(at, size)] = raw[spans((np.cumsum(length) - length)[chosen], size)]
    s = text.astype(np.int16) + 1
    s[at + size] = 0
    sa = suffix_array(s, 257, width)

    starts = spans(at, count[chosen])
    window = np.full(len(s), -1, np.int32)
    window[starts] = np.arange(len(starts))
    order = window[sa]
    order = order[order >= 0]
    shared = common_prefixes(text, starts[order], width)
    doc = np.repeat(least_id, count[chosen])
    group = np.empty(len(starts), np.int64)
    if len(order):
        head = np.flatnonzero(~shared)
        least = np.minimum.reduceat(doc[order], head)
        group[order] = np.repeat(least, np.diff(np.append(head, len(order))))
    base = np.cumsum(count[chosen]) - count[chosen]
    out = group[spans(base[of], count)] < np.repeat(low, count)
    sizes = [int(p[1].astype(np.int64).sum()) for p in parts]
    return np.split(out, np.cumsum(sizes)[:-1])


def hashes_of(raw: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of each of the spans that ``raw`` holds one after the other. Made here, as sending it would take an eighth of all bytes sent."""
    values = kit.byte_values()
    ends = np.cumsum(length)
    out = np.empty(len(length), np.uint64)
    lo = 0
    while lo < len(length):
        begin = int(ends[lo] - length[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, begin + HASHED, side="right")))
        block = raw[begin : int(ends[hi - 1])]
        units = Units(lambda i, j: values[block[i:j]], np.array([0, len(block)]), np.zeros(1, np.int64))  # noqa: B023
        out[lo:hi] = span_hashes(units, ends[lo:hi] - length[lo:hi] - begin, length[lo:hi])
        lo = hi
    return out


def same_spans(hashes: np.ndarray, raw: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """For each span the first span with the same bytes: equal hash and length, then compared byte by byte."""
    order = np.lexsort((length, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (length[order][1:] != length[order][:-1])
    first = np.empty(len(order), np.int64)
    first[order] = order[new][np.cumsum(new) - 1]
    at = np.cumsum(length) - length
    other = np.flatnonzero(first != np.arange(len(first)))
    size = np.cumsum(length[other])
    lo = 0
    while lo < len(other):  # a block of bytes at a time, as copies may be many times the distinct bytes
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + COMPARED, side="right")))
        own = other[lo:hi]
        differs = raw[spans(at[own], length[own])] != raw[spans(at[first[own]], length[own])]
        if differs.any():
            wrong = np.unique(np.repeat(own, length[own])[differs])
            first[wrong] = wrong
        lo = hi
    return first


def dedup_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, seed: int = SEED, as_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``width``-byte string that also starts in a document with a smaller id.

    Adds ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the remaining bytes) to the rows of
    ``docs``, and leaves out the text; columns of these names in the input are replaced. With ``as_text`` the
    text column stays in place of ``kept`` and holds the remaining bytes as text; characters that lost some of their
    bytes are left out.

    Null text has no bytes. A null id counts as smaller than any other. Rows with the same id never remove
    from each other. Strings are judged on the input, and a text shorter than ``width`` keeps all its bytes.
    """
    replaced = [c for c in docs.columns if c.lower() in ("n_bytes", "n_removed", "n_spans", "kept")]
    docs = docs.drop(*replaced)
    out_fields = [f for f in docs.schema.fields if as_text or f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out_fields] + ["n_bytes long", "n_removed long", "n_spans long"] + ["kept binary"] * (not as_text))

    def finish(table: pa.Table, units: Units, buf: np.ndarray, gone: np.ndarray) -> pa.Table:
        bounds = units.bounds
        removed = np.append(0, np.cumsum(gone))
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        inner = bounds[:-1][np.diff(bounds) > 0]
        edge[inner] = gone[inner]
        opened = np.append(0, np.cumsum(edge))
        n_removed = removed[bounds[1:]] - removed[bounds[:-1]]
        kept_bounds = bounds - removed[bounds]
        kept = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(kept_bounds.astype(np.int64).tobytes()), pa.py_buffer(buf[~gone].tobytes())])
        columns = {f.name: table[f.name] for f in out_fields}
        if as_text:
            was = table[text].is_valid().to_pylist()
            texts = [pa.array([b.decode("utf-8", "ignore") if v else None for b, v in zip(kept[i : i + 256].to_pylist(), was[i : i + 256])], pa.string()) for i in range(0, len(was), 256)]
            columns[text] = pa.chunked_array(texts, pa.string())
        columns |= {"n_bytes": pa.array(np.diff(bounds)), "n_removed": pa.array(n_removed), "n_spans": pa.array(opened[bounds[1:]] - opened[bounds[:-1]])}
        return pa.table(columns if as_text else columns | {"kept": kept.cast(pa.binary())})

    return find_repeats(
        docs,
        text,
        lambda table: byte_units(table, text, doc_id),
        min(seed, width // 2 + 1),  # a seed lies inside its window
        width,
        lambda buf: buf,
        lambda buf, first, count, key: [buf[spans(first, count + width - 1)]],
        lambda payloads: array_repeats(payloads, width),
        finish,
        schema,
        "bytes",
    )


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
