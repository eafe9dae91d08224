"""The corpus pipeline: documents in, token shards out.

Low-quality documents go, one document of each near-duplicate group stays, documents that hold benchmark items go,
sources are mixed to target weights, and the rest is written as token shards. Each stage is a function of
``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, mixing, ngram_join, quality, registry, repair
from tallyforge.llm.common import stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the ranking, learned from labelled documents, scores at or above its cut."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group. Rows without id, and without words, stay."""
    parts = ngram_join.jaccard_components(docs)
    drop = parts.where("doc_id <> component_id").select(F.col("doc_id").alias("_copy")).distinct()
    return docs.join(drop, docs["doc_id"] == drop["_copy"], "left_anti")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicate documents by their source's Poisson rate, in a shuffled order."""
    return mixing.mix(docs, registry.TARGETS, registry.MIX_SEED)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token shards and return their index, as read back."""
    return repair.shard_index(repair.write_shards(docs, registry.tokenizer_path()))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_shards),
]

#: Learned scores and edit distances have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
