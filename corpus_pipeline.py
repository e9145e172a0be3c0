"""The corpus pipeline: documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it left. All but the
last give back the columns of documents. Between stages the rows are a Parquet table, so a stage
starts from files, not from a long lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm import linededup, mixing, packing, quality, simhash
from pricewright.llm.common import table
from pricewright.session import ensure_checkpoint_dir

# Pieces that one training sequence holds at most, so that its document mask stays short.
MAX_DOCS = 64


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; references come from the documents themselves."""
    return quality.keep_clean(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated chunks of lines; ``n_chars`` follows the text."""
    kept = linededup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash class."""
    return simhash.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs, max_docs=MAX_DOCS)


STAGES = [
    ("quality rules", clean),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Tokens, fingerprints and chunk hashes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last.

    Tables between stages go to a folder of their own below the shared checkpoint folder. They are read until the
    result has been used, so whoever runs the pipeline deletes the folder afterwards.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
