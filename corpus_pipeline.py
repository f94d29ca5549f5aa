"""From raw documents to packed training sequences.

Stages, in order: quality rules, near-duplicates, repeated substrings, benchmark passages, packing. Each works on what the one
before it kept; all but the last return the columns of ``documents``. Rows with a null text fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import decontam, neardup, packing, quality, suffix
from tillhouse.llm.queries import table, tokenizer_path
from tillhouse.session import configure, materialize

NEAR_PERCENT = 80  # similarity of shingle sets from which the pipeline takes documents for near copies; op7 has 85
BATCH_ROWS = 2048  # rows of texts that pass to a Python task at once


def prepare(spark: SparkSession) -> None:
    """Settings of a stage. Batches of texts are held by the JVM and by Python at the same time, so they are kept small."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    prepare(spark)
    return quality.judge(docs).where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more): the one with the smallest id."""
    prepare(spark)
    kept = neardup.near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes that repeat a document with a smaller id; the length follows."""
    prepare(spark)
    cleaned = suffix.dedup_bytes(docs, as_text=True)
    return cleaned.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage occurs in."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", substring_dedup),
    ("decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

# Suffix arrays over bytes, near-duplicate classes and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
