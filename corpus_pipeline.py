"""Corpus pipeline: quality, exact dedup, SimHash near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes
each result to the shared folder and gives it to the next stage, so a lost
executor costs tasks of one stage.  All stages but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import exact_dedup, packing, quality, simhash, substring_dedup
from tillbook.llm.common import stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document of a smaller id has, n_chars renewed."""
    return substring_dedup.drop_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("substring_dedup", passages), ("packing", sequences)]

#: A learned score decides the first stage, which SQL cannot express; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
