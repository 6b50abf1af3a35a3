"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  ``run`` writes
every stage but the last to the shared folder, reads it back and removes the
table that it came from.

Edge cases: null or empty texts, null ids and repeated rows go through every
stage as its operator defines (they are no duplicates of anything, hold no
leak and weigh 0 words); an empty table gives an empty result; extra columns
stay."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from faultline.llm.common import stored
from faultline.llm.queries import read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("mixture", mix_sources),
    ("shards", shard_documents),
]

#: Learnt lexicons, minima and approximate quantiles have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", [docs])
    return STAGES[-1][1](spark, docs, sf_dir)
