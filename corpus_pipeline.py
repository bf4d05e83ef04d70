"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet and read again;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wageledger.llm import line_dedup, mixing, packing, quality_model, simhash
from wageledger.llm.queries import MIX_SEED, TOKENIZER, WEIGHTS, table
from wageledger.llm.text import free_name
from wageledger.sinks.scratch import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects."""
    name = free_name(docs, "score")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs, model, name=name)
    return scored.where(scored[name] >= quality_model.THRESHOLD).drop(name)


def fuzzy_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that an earlier line equals or nearly equals."""
    return line_dedup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group."""
    return simhash.deduplicate(docs, shingle=3, distance=2)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents until the sources have their weights, in random order."""
    return mixing.mix(docs, WEIGHTS, seed=MIX_SEED, places=False)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path(TOKENIZER), limit=4096), limit=4096)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("fuzzy_lines", fuzzy_lines),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

# A trained classifier has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
