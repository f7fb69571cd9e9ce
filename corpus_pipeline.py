"""A training corpus from ``documents``, in stages.

Quality rules, near duplicates, repeated strings, benchmark passages, tokens.
Every stage takes what the one before kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeway.llm import decontam, jaccard, quality, spm, suffixes
from bronzeway.llm.common import fresh, ready, stored
from bronzeway.sources.tables import read_table

# Tokens and alignments are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ready(spark)
    return quality.measure(docs).filter("kept").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, 0.8 or more)."""
    return jaccard.one_per_component(docs, n=5, percent=80)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 200 bytes that also start elsewhere."""
    cut = suffixes.remove_repeats(docs)
    return cut.withColumns(
        {"text": F.when(F.col("text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast("bigint")}
    ).select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    items = read_table(spark, f"{sf_dir}/benchmark.parquet")
    key = fresh("key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64("text"))
    held = decontam.matches(keyed, items, id=key).select(key).distinct()
    return keyed.join(held, key, "left_anti").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    rows = spm.encode(docs.select("doc_id", "lang", "source", "text"), spm.read_model())
    return rows.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").alias("n_tokens"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
        "parity",
    )


STAGES = [
    ("quality rules", keep_good_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("suffix-array dedup", remove_repeated_strings),
    ("benchmark decontamination", drop_benchmark_passages),
    ("SentencePiece encoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(ready(spark), docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
