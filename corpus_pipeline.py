"""From raw documents to training shards: five stages, each over all that the one before kept.

A stage takes and returns a table with the columns of ``documents``; the last returns the place of
every row in the shards. Tables are written between stages, so a lost executor costs one stage's
work at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontam, jaccard, mixing, sharding, toxicity
from cohortlens.llm.common import table
from cohortlens.llm.queries import MIX
from cohortlens.session import new_table_path

#: Near copies share 80 hundredths of their shingles of 5 words (``op8_jaccard_join`` has a contract of its own).
NEAR_WORDS = 5
NEAR_THRESHOLD = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return jaccard.one_of_each(docs, NEAR_WORDS, NEAR_THRESHOLD)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as the documents have, in the shares of the mix; rows repeat by epoch."""
    return mixing.mixed_documents(docs, MIX)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The toxicity model can't be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
