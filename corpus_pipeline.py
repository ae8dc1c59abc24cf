"""A training corpus from raw documents: five stages, each an operator of ``lorekeep.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
``run`` writes what a stage returns as Parquet in the shared folder and reads it as the next
one's input, so a lost executor costs one stage at most.  Every stage but the last
returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorekeep.llm import decontam, mixing, near_dup, quality, tokens
from lorekeep.llm.common import batches_from_here, materialize, table

#: Whole texts that executors and their workers send each other at once: what is sent at once stays with an executor's process,
#: next to what all stages before have left there.
ROWS = 512


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, doesn't reject."""
    batches_from_here(spark, ROWS)
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with benchmark items."""
    batches_from_here(spark, ROWS)
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def by_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources in training order, a row for each time a document is taken."""
    return mixing.mixed(docs)


def as_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix; returns their summary by document."""
    return tokens.token_output(docs, "pipeline-tokens")


STAGES = [
    ("quality classifier", by_quality),
    ("near-duplicates", without_near_duplicates),
    ("benchmark decontamination", without_benchmarks),
    ("mixing to target weights", by_target_weights),
    ("token-id output", as_token_ids),
]

#: The classifier, similarity estimates and tokenizer have no SQL form; tests hold the rows to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
