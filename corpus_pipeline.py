"""Corpus pipeline: documents through five operators in a row, each stage written and read again.

A stage is a name and a function of (spark, docs, sf_dir).  It works on all rows that its predecessor
kept.  All stages but the last return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakezones.llm.common import stored, table
from lakezones.llm.decontam import without_leaks
from lakezones.llm.jaccard import representatives
from lakezones.llm.lang_crf import fit_documents, in_language
from lakezones.llm.packing import pack_documents
from lakezones.llm.queries import tokenizer_path
from lakezones.llm.suffix_dedup import without_repeats

BLOCK_BYTES = 2 << 20  # of text in work in a task; executors also hold what the JVM grew to in earlier stages
WORD_CACHE = 150_000  # parts; workers serve all stages in turn, and what one keeps the next cannot use


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a clear language go."""
    return in_language(docs, fit_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at 80 % of 5-word shingles stays."""
    return representatives(docs, k=5, num=80, den=100, block_bytes=BLOCK_BYTES)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that 50-byte strings of smaller documents cover are cut; no document goes."""
    return without_repeats(docs, block_bytes=BLOCK_BYTES)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), keep_ids=False, cache_parts=WORD_CACHE)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("benchmark_leaks", benchmark_leaks), ("packing", packing)]

#: Trained models, suffix names and a tokenizer have no SQL twin; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
