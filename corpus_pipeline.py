"""Documents to shards: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes the documents that the stage before has kept and decides over
all of them. All but the last return the columns of documents. Models are
trained on the documents that reach the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import decontamination, jaccard, mixing, quality_model, sharding
from panelspark.llm.stage import staged, whole_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality scorer does not reject."""
    return quality_model.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark window occurs."""
    return decontamination.clean_documents(docs, whole_documents(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn with the raked probabilities of their source, language and topic."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of forty shards."""
    return sharding.manifest(docs, sharding.tree(40), grown=sharding.tree(41))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: Hash draws, trained models and crc32 have no counterpart in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = whole_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
