"""The operators as queries over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import centroids, decontam, langid, licenses, neardup, neighbours, packing, phrases, quality, suffix, tokens, urls, windows
from tillhouse.session import configure

Query = Callable[[SparkSession, str], DataFrame]

HELD_OUT = 2  # remainder of the hash of the id, of four


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file: in the folder ``TOKENIZER_DIR`` names, else in the installed package."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.join(os.path.dirname(spec.origin), name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("license_sentences", ",").alias("license_sentences"), F.array_join("licenses", ",").alias("licenses"), "license_verdict")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, ~held_out & F.col("lang").isNotNull())
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_pages(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenized(table(spark, sf_dir, "documents"), tokenizer_path())


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.digest(windows.dedup_words(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1,
    "op2_language_id": op2,
    "op3_url_filter": op3,
    "op4_decontamination": op4,
    "op5_token_output": op5,
    "op6_packing": op6,
    "op7_near_dedup": op7,
    "op8_quality_rules": op8,
    "op9_suffix_dedup": op9,
    "op10_substring_dedup": op10,
    "op11_phrase_collocations": op11,
    "op12_centroid_clustering": op12,
    "op13_nearest_neighbours": op13,
}
