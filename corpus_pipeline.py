"""A corpus pipeline: quality rules, near-duplicate documents, repeated passages, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of `documents`.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parley.llm import jaccard, packing, quality, substrings
from parley.registry.base import ship_package, table
from parley.sources.workspace import new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the fences of their language and source."""
    ship_package(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the exact Jaccard join links."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the paragraphs and passages that an earlier document has."""
    ship_package(spark)
    return substrings.remove_repeats(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packed_sequences),
]

#: Components, paragraphs that come near and token ids are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
