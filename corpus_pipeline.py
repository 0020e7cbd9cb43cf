"""Preparing a training corpus: stages over ``documents``, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``.  ``run`` stores each result as Parquet in the shared folder and reads it again.  Null
and empty texts, repeated rows, empty tables and extra columns are handled as the operators'
docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import langid, lines, minhash, mixing, packing
from linkloom.llm.common import short_batches, table
from linkloom.session import ensure_checkpoint_dir

#: Near duplicates of the corpus are linked from here on; op4 alone asks for 85.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or no liker any known language than chance explains, go."""
    short_batches(spark)
    return langid.reject_unknown(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three or more documents stay in one; documents left without text go."""
    short_batches(spark)
    return lines.drop_repeated_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays; a Jaccard similarity of 0.80 links two."""
    short_batches(spark)
    return minhash.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or the part of them taken, once for each round of the mix that takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, their texts and their place in sequences of several lengths."""
    short_batches(spark)
    return packing.pack(docs, texts=True).drop("_row")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Profiles, packing and the permutations of the mix cannot be expressed in SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
