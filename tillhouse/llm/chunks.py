"""Texts packed into compressed chunks, and messages between chunks and buckets.

A chunk is some megabytes of whole rows as one Arrow stream. Chunks are written once to the shared folder, so their
numbers stay the same whichever executor is lost. Later passes send small binary messages keyed by bucket or chunk
instead of one Spark row per position, and what a chunk holds more than once is sent once. A key that is very
frequent in the corpus is thus one entry per chunk, not one per occurrence.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.ship import ship_package
from tillhouse.llm.textkit import give_back, giving_back
from tillhouse.session import materialize

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
PACKED = pa.Codec("zstd", 6)  # a chunk is packed once, but written three times: stored, and sent by two shuffles
MESSAGE = "dest long, src long, kind int, payload binary"
_MESSAGE = pa.schema([("dest", pa.int64()), ("src", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])


def pack_table(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=PACKED)) as w:
        w.write_table(table)
    return out.getvalue()


def unpack_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, compressed."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]))


def unpack_arrays(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, count, 8)
    ends = np.cumsum(sizes) + 8 * (count + 1)
    return [np.frombuffer(raw, k, int(s) // np.dtype(k).itemsize, int(e - s)) for k, s, e in zip(kinds, sizes, ends)]


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [()] * 4, _MESSAGE)], schema=_MESSAGE)


def chunked(df: DataFrame, text: str, label: str, target: int = CHUNK_BYTES) -> DataFrame:
    """All rows of ``df`` as chunks (dest, src, kind = -1, payload), plus the text bytes of each in ``n_bytes``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 31, 0
        held: list[pa.Table] = []
        size = 0

        def flush():
            table = pa.concat_tables(held).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([size], pa.int64()), pa.array([pack_table(table)], pa.binary())],
                names=["dest", "n_bytes", "payload"],
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = pa.compute.binary_length(table[text]).fill_null(0).to_numpy()
            begin = 0
            for i, n in enumerate(lengths):
                if size and size + n > target:
                    if i > begin:
                        held.append(table.slice(begin, i - begin))
                    yield flush()
                    held, size, made, begin = [], 0, made + 1, i
                size += int(n)
            if len(lengths) > begin:
                held.append(table.slice(begin))
        if held:
            yield flush()

    ship_package(df.sparkSession)
    out = df.mapInArrow(giving_back(pack), "dest long, n_bytes long, payload binary")
    return materialize(out, label)


def as_messages(chunks: DataFrame) -> DataFrame:
    return chunks.select("dest", F.lit(0).cast("long").alias("src"), F.lit(-1).alias("kind"), "payload")


def each(chunks: DataFrame, work: Callable[[int, bytes], list]) -> DataFrame:
    """Messages that ``work(chunk, payload)`` makes from every chunk, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dest, payload in zip(batch.column("dest").to_pylist(), batch.column("payload")):
                yield from messages(work(dest, payload.as_py())).to_batches()

    return chunks.mapInArrow(giving_back(run), MESSAGE)


def gathered(msgs: DataFrame, work: Callable[[int, list], list]) -> DataFrame:
    """Messages that ``work(dest, [(src, kind, payload), ...])`` makes from all messages to one destination."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["src"].to_pylist(), table["kind"].to_pylist(), table["payload"].to_pylist()), key=lambda r: r[:2])
        out = messages(work(table["dest"][0].as_py(), rows))
        give_back()
        return out

    return msgs.groupBy("dest").applyInArrow(run, MESSAGE)


def concluded(msgs: DataFrame, work: Callable[[list], pa.Table], schema: str) -> DataFrame:
    """Rows that ``work`` makes from a chunk and the messages sent to it."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["kind"].to_pylist(), table["src"].to_pylist(), table["payload"].to_pylist()), key=lambda r: r[:2])
        out = work(rows)
        give_back()
        return out

    return msgs.groupBy("dest").applyInArrow(run, schema)
