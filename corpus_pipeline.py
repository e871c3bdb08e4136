"""Corpus preparation: the stages that turn raw documents into training shards.

Each stage takes the rows that the one before kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import table
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.language import Profiles, keep_identified
from millrace.llm.mixing import Mix, mixed_documents
from millrace.llm.near_dup import AT_80, drop_near_duplicates
from millrace.llm.queries import held_out
from millrace.llm.sharding import shard_documents
from millrace.session import configure, discard, scratch_dir

PROFILES = Profiles(dimensions=1024, seed=11, train_docs=2000)
# A text of some length that resembles no language is junk; short ones have noisy scores.
MIN_SCORE, SCORED_BYTES = 0.3, 200
# One epoch: a document is taken or left, never repeated.
MIX = Mix(
    weights={"domain": {"crawl": 3, "curated": 7}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}},
    share_percent=90,
    max_epochs=1,
    seed=23,
)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or like no language go."""
    return keep_identified(docs, PROFILES, ~held_out(), MIN_SCORE, SCORED_BYTES)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicates(docs, AT_80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to the target weights of the sources."""
    return mixed_documents(docs, MIX)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All of them with their shard and slot."""
    return shard_documents(docs, shards=40)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# Language profiles are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read back; a stage's input goes once its output is there."""
    docs, before = table(configure(spark), sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
