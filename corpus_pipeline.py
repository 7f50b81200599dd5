"""From raw documents to a shuffled, mixed training corpus.

Each stage reads what its predecessor kept, written as Parquet, and returns documents
with their columns; the last one adds shard and slot.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickmart.llm import decontaminate, minhash, mixing, quality, sharding
from clickmart.llm.common import table
from clickmart.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def shuffle_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in uniformly shuffled shards: shard and slot are added."""
    return sharding.place(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("shuffle_shards", shuffle_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: robust estimates, hash minima and hypergeometric draws have no SQL
ORACLE_SQL = None
