"""Pipeline over ``documents``: a list of stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import decontaminate, minhash, mixing, quality, sharding
from tagloom.llm.common import read_table, stored_order
from tagloom.llm.queries import CURRICULUM, SHARDS
from tagloom.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.keep_accepted(docs, read_table(spark, sf_dir, "labels"), stored=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id: five-word shingles, 0.8."""
    return minhash.keep_first(docs, size=5, threshold=(4, 5), stored=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that share no ten words in a row with a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the curriculum takes it, in training order; one a source may be cut."""
    mixed = mixing.mixed_documents(docs, lambda sources: mixing.repeating_weights(sources, CURRICULUM), stored=True)
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, near equal in bytes, and slot, which follows the training order."""
    return sharding.shard_documents(docs, SHARDS, order=stored_order(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]
# The stages train models and pack greedily, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
