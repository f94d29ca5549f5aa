"""Substring deduplication over words by one doubling of the window, from half the length to the whole."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import textkit as kit
from tillhouse.llm.chunks import unpack_arrays
from tillhouse.llm.repeats import Units, document_ids, find_repeats
from tillhouse.llm.suffix import spans

WIDTH = 50


def word_units(table: pa.Table, text: str, doc_id: str):
    buf, bounds = kit.joined(table[text], separator=True)
    starts, ends, of_doc = kit.word_bounds(buf, bounds)
    values = kit.word_hashes(buf, starts, ends, lower=False)
    return Units(lambda lo, hi: values[lo:hi], of_doc, document_ids(table[doc_id])), (buf, bounds, starts, ends, values)


def double(h: np.ndarray, first: np.ndarray, count: np.ndarray, half: int, width: int) -> np.ndarray:
    """Hashes of the windows of ``width`` at each run, put together from the hashes ``h`` of two overlapping windows of ``half`` words."""
    at = spans(first, count)
    return kit.mix(h[at] * np.uint64(0x9FB21C651E98DF25) + h[at + width - half])


def window_repeats(payloads: list[bytes]) -> list[np.ndarray]:
    parts = [unpack_arrays(p, np.int64, np.uint16, np.uint64) for p in payloads]
    doc = np.concatenate([np.repeat(p[0], p[1].astype(np.int64)) for p in parts])
    keys = np.concatenate([p[2] for p in parts])
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    out = np.zeros(len(keys), bool)
    if len(k):
        head = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        least = np.minimum.reduceat(doc[order], head)
        out[order] = np.repeat(least, np.diff(np.append(head, len(k)))) < doc[order]
    return np.split(out, np.cumsum([len(p[2]) for p in parts])[:-1])


def dedup_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also starts in a document with a smaller id.

    The first level looks at windows of half the length (rounded up). Only where such a window repeats are windows
    of the full length looked at, so most of the corpus leaves after the first level. Of the half windows inside a full
    one it is enough to look at one that the content picks: a repeated window repeats all its halves.

    Words are runs of anything but blanks and control breaks and are compared unchanged, by 64-bit hashes. Adds
    ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one blank) to the rows of ``docs`` and leaves out the text;
    columns of these names in the input are replaced. Null text has no words. A null id counts as smaller than any
    other. Rows with the same id never remove from each other. Windows are judged on the input.
    """
    if width < 2:
        raise ValueError("a window needs two words or more")
    half = -(-width // 2)
    replaced = [c for c in docs.columns if c.lower() in ("n_words", "n_removed", "kept")]
    docs = docs.drop(*replaced)
    out_fields = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out_fields] + ["n_words long", "n_removed long", "kept string"])

    def finish(table: pa.Table, units: Units, extra, gone: np.ndarray) -> pa.Table:
        buf, bounds, starts, ends, _ = extra
        words = units.bounds
        removed = np.append(0, np.cumsum(gone))
        keep = np.flatnonzero(~gone)
        doc = np.searchsorted(words, keep, side="right") - 1
        last = np.ones(len(keep), bool)
        last[:-1] = doc[1:] != doc[:-1]
        length = ends[keep] - starts[keep] + ~last  # the byte behind a word becomes the blank
        picked = buf[spans(starts[keep], length)]
        at_end = np.cumsum(length) - 1
        picked[at_end[~last]] = 32
        per_doc = np.bincount(doc, weights=length, minlength=len(words) - 1).astype(np.int64) if len(keep) else np.zeros(len(words) - 1, np.int64)
        kept_bounds = np.append(0, np.cumsum(per_doc)).astype(np.int64)
        kept = pa.Array.from_buffers(pa.large_string(), len(words) - 1, [None, pa.py_buffer(kept_bounds.tobytes()), pa.py_buffer(picked.tobytes())])
        columns = {f.name: table[f.name] for f in out_fields}
        columns |= {"n_words": pa.array(np.diff(words)), "n_removed": pa.array(removed[words[1:]] - removed[words[:-1]])}
        return pa.table(columns | {"kept": kept.cast(pa.string())})

    return find_repeats(
        docs,
        text,
        lambda table: word_units(table, text, doc_id),
        half,
        width,
        lambda extra: kit.window_hash(extra[4], half),
        lambda halves, first, count, key: [double(halves, first, count, half, width)],
        window_repeats,
        finish,
        schema,
        "words",
    )


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
