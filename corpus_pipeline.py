"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes the documents its predecessor kept, with their columns, and returns
them with those columns; the last one returns token ids.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import bpe, linededup, mixing, simhash
from vitrine.llm.common import stored
from vitrine.llm.quality import keep_good
from vitrine.llm.queries import vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left."""
    mark = "cut"
    while mark in docs.columns:  # a name of its own
        mark += "_"
    done = linededup.drop_repeated_lines(docs, mark=mark)
    changed = F.col(mark) > 0
    if "n_chars" in docs.columns:
        done = done.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        )
    return done.filter(~changed | (mixing.words_in(F.col("text")) > 0)).drop(mark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates (five-word shingles, 0.8)."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to twice."""
    return mixing.mix(docs, max_epochs=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed 32-bit) of every document, and the text they decode to.

    Columns called ``ids``, ``decoded`` or ``n_tokens`` are replaced.
    """
    keep = [c for c in docs.columns if c not in ("text", "n_chars")]
    coded = bpe.round_trip(docs, vocabulary_path(), keep=keep)
    return coded.withColumn("n_tokens", F.expr("CAST(length(ids) / 4 AS BIGINT)"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Hash functions, sketches and merge ranks have no SQL form; the stages are held against
# brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
