"""What the pipeline's stages leave in Python workers and hand to them at once."""

from __future__ import annotations

import re

import pyarrow as pa

import corpus_pipeline
from tillhouse.llm import packing, tokens
from tillhouse.llm.queries import tokenizer_path


def test_batches_of_texts_are_small(docs, spark):
    def rows_of_batches(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)])], names=["n"])

    frame = docs([(i, f"text {i}") for i in range(3)])
    for name, stage in corpus_pipeline.STAGES:
        if name not in ("near_dedup", "suffix_dedup", "packing"):
            continue  # the others have no Python tasks
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        try:
            stage(spark, frame, "")
            sizes = spark.range(9000).coalesce(1).mapInArrow(rows_of_batches, "n long").collect()
            assert max(r.n for r in sizes) <= corpus_pipeline.BATCH_ROWS, name
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_an_encoder_forgets_its_words_and_goes_on():
    encode = tokens.Encoder(tokenizer_path())
    texts = ["some words, and others.\nmore"]
    want = encode(texts)
    encode.forget()
    assert "words" not in encode.known
    assert encode(texts) == want


class Tasks:
    """In place of a table: gives the function of its Python tasks."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def megabytes():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", f.read()))) / 1024


def test_a_task_that_ended_holds_little_memory(spark):
    task = packing.token_pieces(Tasks(), tokenizer_path(), "text", "doc_id", 2048)

    def batch(i, many, words):
        text = [" ".join(f"{'qwertyuiop'[k % 10]}{k * 2654435761 % 2**32:x}" for k in range(n * words, (n + 1) * words)) for n in range(i * many, (i + 1) * many)]
        return pa.RecordBatch.from_arrays([pa.array(range(many)), pa.array(text)], names=["doc_id", "text"])

    assert sum(map(len, task(iter([batch(0, 1, 10)])))) == 1  # the vocabulary is loaded
    before, at_work = megabytes(), 0
    for _ in task(batch(i, 250, 400) for i in range(3)):
        at_work = max(at_work, megabytes() - before)
    left = megabytes() - before
    assert left < 0.3 * at_work, (left, at_work)
