"""A training corpus from ``documents``: five stages, each written and read again.

Quality rules drop poor documents, exact and near duplicates leave one
document of each group, personal data is replaced by its kind, and what is
left is packed into sequences of 2048 tokens.

Every stage takes null, empty and very long texts, null and repeated ids,
empty tables and further columns of any name; what becomes of them stands at
the operator that it calls. As a stage's docs are what the stage before has
written, a stage begins by deleting the intermediate tables that its docs don't
read.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import exact_dedup, packing, pii, quality_rules, shared, simhash_trie

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    """A stage deletes what earlier ones have left, but for what its docs read, before it begins."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with shared.scope("pipeline"):
            shared.sweep(spark, docs)
            return f(spark, docs, sf_dir)

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go."""
    return quality_rules.keep_good(docs)


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty), one row: that with the smallest id, one without an id if none has."""
    index = exact_dedup.new_index(spark)
    kept = exact_dedup.keep_first(docs, index)
    index.drop()
    return kept


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, one row: that with the smallest id, one without an id if none has."""
    return simhash_trie.keep_one(docs)


@stage
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced; n_chars, where there is one, follows the new text; null texts stay null."""
    clean = pii.redacted(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences; null and empty texts have a piece of one id."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("pii", private),
    ("best_fit_packing", pack),
]

#: Rules fitted by expectation-maximisation, fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result as Parquet in the shared folder and read again.

    Intermediate tables go as soon as the stage after them is done. The last
    result is the caller's: it stays where it was written.
    """
    docs = shared.read_table(spark, sf_dir, "documents")
    with shared.scope(f"run-{uuid.uuid4().hex}"):
        for k, (name, each) in enumerate(STAGES):
            made = each(spark, docs, sf_dir)
            path = f"{shared.shared_dir(spark)}/leafmill-pipeline-{uuid.uuid4().hex}" if k == len(STAGES) - 1 else shared.scratch(spark, name)
            made.write.parquet(path)
            docs = spark.read.parquet(path)
        shared.sweep(spark, docs)
    return docs
