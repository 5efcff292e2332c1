"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import class_lm, exact_dedup, language_id, packing, piece_codec, pii, quality_rules, simhash_trie, toxicity, url_filter
from .shared import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.assess(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality", "votes"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode(read_table(spark, sf_dir, "documents"), with_ids=False)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(read_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two halves by id: the second meets the digests of the first in the index."""
    index = exact_dedup.new_index(spark)
    found = exact_dedup.groups(read_table(spark, sf_dir, "documents"), index, batches=2)
    index.drop()
    return found


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(pages))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


OP8_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_toxicity": op3_toxicity,
        "op4_simhash_near_dedup": op4_simhash_near_dedup,
        "op5_piece_codec": op5_piece_codec,
        "op6_pii": op6_pii,
        "op7_class_lm": op7_class_lm,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_url_filter": op9_url_filter,
        "op10_language_id": op10_language_id,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": OP8_SQL}
