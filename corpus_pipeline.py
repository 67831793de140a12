"""From raw documents to shards: quality, near duplicates, benchmark leaks, mix, shards. Each stage takes (spark, docs, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debenture.llm import decontam, jaccard, mixing, quality, sharding
from debenture.llm.common import discard, saved, working


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the classifier reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # under names of the stage's own, so that no column of docs is taken for one of the operator's
    own = docs.select(*[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(docs.columns)])
    kept = quality.judged(own, model, text=f"own_{docs.columns.index('text')}").filter("kept")
    return kept.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a benchmark item leaks into."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of equally many rows, each in random order: columns shard and slot."""
    return sharding.shard(docs)


STAGES = [("quality", quality_stage), ("near_duplicates", duplicate_stage), ("decontamination", benchmark_stage), ("mix", mix_stage), ("shards", shard_stage)]

#: The classifier and the drawn shards are beyond SQL; tests/llm hold each stage against what it was given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        # what a stage writes on its way goes with it, what it was given goes as the next table has been written
        with working(spark) as keep:
            docs = keep(saved(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
