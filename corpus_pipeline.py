"""Corpus pipeline: five stages, each written as Parquet and read again by the next.

quality: documents that fail the base rules or the learned decision list go. near_duplicates: of
each group of linked documents (five-word shingles, similarity 0.8) the one with the smallest id
stays, once. decontaminate: documents that leak a benchmark item go. mix: documents are
repeated by source until the most repeated source is passed twice for a pass of the largest; none is lost.
shard: documents get a shard and a slot; shards have nearly equal bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionledger.llm import jaccard, mixing, quality, registry, sharding, templates
from regionledger.sources import scratch

#: The stages learn, sketch and bisect; SQL can't express them.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the list is learned from the labels of the stage's own input."""
    rules = quality.fit(docs, registry.table(spark, sf_dir, "labels"))
    judged = quality.apply(docs.select("text", F.struct(*docs.columns).alias("row")), rules, keep=["row"])
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    return jaccard.keep_one(docs, jaccard.Likeness(5, 4, 5))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, its values changed or not, go."""
    return templates.clean(docs, registry.table(spark, sf_dir, "benchmark"), whole=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every pass of a document."""
    return mixing.mix(docs, repetition_limit=registry.REPETITION_LIMIT).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    return sharding.assign(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = registry.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.materialise(stage(spark, docs, sf_dir))
    return docs
