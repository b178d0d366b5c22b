"""A corpus pipeline: drop toxic documents, keep one of each near-duplicate group, mix the sources, pack into windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import mixing, packing, simhash, toxicity
from plumbline.llm.common import table
from plumbline.llm.queries import toxicity_model, word_vocabulary
from plumbline.session import new_table_path

# A classifier, 64-bit fingerprints and a tokenizer take part: SQL cannot express it. tests/llm has brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, after training on the labels of the table beside them."""
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by 4 or fewer fingerprint bits."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one taken twice is there twice."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return packing.pack(docs, word_vocabulary())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("mixing", mix_sources),
          ("packing", pack_windows)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
