"""The corpus pipeline: rules, near duplicates, decontamination, mixing and sharding, in this order.

Every stage but the last keeps the columns of ``documents``. Null and empty texts fail the rules of the
first stage; were they given to a later stage, each would take them as texts without words. Empty tables
pass through all stages and give an empty result. Rows repeated as a whole are one document to the
near-duplicate stage, which keeps one of them. Extra columns stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import decontaminate, mixing, quality, shards, simhash
from riskspark.llm.common import stored, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules or the distribution divergence reject go."""
    return quality.filtered(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints stays, with the operator's contract: shingles of
    four words, four differing bits."""
    return simhash.deduplicated(docs, size=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources come up to twice; none goes."""
    return mixing.mixed(docs, target="repeats", limit=2.0)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; the columns are the sharding operator's."""
    return shards.sharded(docs, shards=24)


STAGES = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("shards", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's table is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


ORACLE_SQL = None
