"""Documents packed into sequences by bulk-synchronous best fit.

Pieces are range-sorted by length, longest first. A step of the sweep takes all pieces of one length and all gaps of the
smallest size that still holds them: piece and gap of the same rank match, and the gaps shrink. Steps repeat until every
length is placed; pieces that no gap holds open sequences. Because equal lengths and equal gaps are interchangeable, a step
is one line of a plan (ranks from-to of a length go to sequences from-to). Lengths are whole numbers up to the capacity, so
the sweep's state and the plan have a size that depends on the capacity alone, and Spark applies the plan to all pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.llm.ship import ship_package
from tillhouse.llm.textkit import giving_back
from tillhouse.llm.tokens import END, encoder
from tillhouse.session import materialize

CAPACITY = 2048
WORDS = 1 << 18  # words whose ids a task keeps; they go when it ends


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first takes what is over, all others are full."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The plan: (length, first rank, how many, first sequence, offset) of each step."""
    plan = []
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, how many)
    sizes: list[int] = []  # gaps that have runs, ascending
    opened = 0

    def free(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in runs:
                runs[gap] = []
                insort(sizes, gap)
            runs[gap].append((first, many))

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, many = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap]
                    sizes.pop(at)
            else:
                gap, first, many = capacity, opened, -(-left // (capacity // length))
                opened += many
            # the gap that is left is smaller, so the next piece of this length goes into the same sequence
            each = gap // length
            full = min(many, left // each)
            for k in range(each if full else 0):
                plan.append((length, rank, full, first, capacity - gap + k * length))
                rank += full
            left -= full * each
            free(gap - each * length, first, full)
            if full < many:
                some = min(left, each)
                for k in range(some):
                    plan.append((length, rank, 1, first + full, capacity - gap + k * length))
                    rank += 1
                left -= some
                free(gap - some * length, first + full, 1)
                free(gap, first + full + 1, many - full - 1)
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, text: str, doc_id: str, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, WORDS)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                rows = []
                for d, code in zip(part.column("doc_id").to_pylist(), encode([t or "" for t in part.column("text").to_pylist()])):
                    code += end
                    for i, (start, n) in enumerate(cut(len(code) // 4, capacity)):
                        rows.append((d, i, start, n, zlib.crc32(code[4 * start : 4 * (start + n)])))
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        encode.forget()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(giving_back(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and the end id 0; null and empty texts are the end id alone. Only documents longer than
    ``capacity`` are cut. Repeated rows are documents of their own, and a null id is kept. Offsets in a sequence are gapless.
    """
    ship_package(docs.sparkSession)
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    pieces = materialize(token_pieces(docs, tokenizer, text, doc_id, capacity), "pieces")
    ordered = pieces.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ordered = materialize(ordered.withColumn("_part", F.shiftright("_at", 33)), "ordered")
    # equal lengths stand together, so a rank is the place in the partition plus what earlier partitions hold
    here = ordered.groupBy("_part", "length").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")
    here = here.select("_part", "length", "_first", before.alias("_before"))
    counts = {r[0]: r[1] for r in ordered.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = docs.sparkSession.createDataFrame(best_fit(counts, capacity), "length long, lo long, many long, sequence long, offset long")
    ranked = ordered.join(here, ["_part", "length"]).withColumn("_rank", F.col("_at") - F.col("_first") + F.col("_before"))
    # the plan's size depends on the capacity alone
    placed = ranked.join(F.broadcast(plan), (ranked.length == plan.length) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("lo") + F.col("many")))
    return placed.select(
        "doc_id", "piece", "start", ranked.length, "ids_crc32", (F.col("sequence") + F.col("_rank") - F.col("lo")).alias("sequence_id"), "offset"
    )
