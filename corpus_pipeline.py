"""The corpus pipeline: documents through five operators, one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crawldelta.llm import blocks, decontam, pieces, quality, simhash
from crawldelta.llm.queries import tokenizer_file
from crawldelta.llm.scratch import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return blocks.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints (three-word shingles) linked within two bits, the document with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' best segmentations with their round trip."""
    return pieces.encode_documents(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("sentencepiece", pieces_stage),
]

#: The classifier, the fingerprints and the lattice have no SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each result written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
