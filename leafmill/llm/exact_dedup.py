"""Exact deduplication against a persistent digest index.

The index is a Parquet table of ``(digest, keep_id)``, bucketed and sorted by
digest. New data is reduced to one row per digest (partial aggregation, so a
group of copies of any size costs one row per map task), anti-joined with the
index by sort-merge on the buckets, and what is new is appended. Rows then get
their group by one equi-join whose two sides are plain exchanges, so adaptive
execution splits the partition of a very large group.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import WS, drop_path, fresh, materialise, numbered, plain_columns, scratch


def normalised(text: Column) -> Column:
    """Null as empty; each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WS}+", " ")


def digest(text: Column) -> Column:
    """SHA-256, lowercase hexadecimal, of the normalised text in UTF-8."""
    return F.sha2(normalised(text).cast("binary"), 256)


class DigestIndex:
    """A set of digests that outlives the session.

    ``path`` holds the bucketed Parquet files; ``buckets`` must be the same at
    every opening. Opening registers the files as an external table under a
    name made from the path, so a new session finds what an earlier one wrote.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = "leafmill_digests_" + uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        """The index as a bucketed table: a join on digest needs no exchange on this side."""
        return self.spark.table(self.table)

    def plain(self) -> DataFrame:
        """The same rows without their buckets, for joins that may have to be split."""
        return self.spark.read.schema(self.rows().schema).parquet(self.path)

    def add(self, firsts: DataFrame) -> None:
        """Append the rows of ``firsts`` (digest, keep_id) whose digest is not known yet.

        ``firsts`` must have one row per digest.
        """
        new = firsts.select("digest", "keep_id").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (
            new.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        drop_path(self.spark, self.path)


def _decided(marks: DataFrame, index: DigestIndex, batches: int) -> DataFrame:
    """digest, keep_id, group_size and row (that stays, null if none does) of each digest of ``marks`` (digest, doc_id, row).

    ``marks`` comes in ``batches`` ranges of ids, smallest first, rows without
    an id last. Each batch is reduced to its digests, which meet those that the
    index knows, of earlier batches too. A partial minimum is taken by every
    task, so a group of copies is a row a task, whatever its size.
    """
    row = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "row")
    ends = marks.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (ends[0] or 0), (ends[1] or 0)
    part = F.floor((F.col("doc_id").cast("double") - float(low)) / float((high - low) // batches + 1))
    part = F.coalesce(F.least(part, F.lit(batches - 1)), F.lit(batches - 1))
    firsts = []
    for k in range(batches):
        batch = marks.where(part == k) if batches > 1 else marks
        firsts.append(materialise(batch.groupBy("digest").agg(F.min(row).alias("first"), F.count("*").alias("group_size"))))
        index.add(firsts[-1].select("digest", F.col("first.doc_id").alias("keep_id")))
    whole = firsts[0]
    if batches > 1:
        every = functools.reduce(DataFrame.unionByName, firsts)
        whole = materialise(every.groupBy("digest").agg(F.min("first").alias("first"), F.sum("group_size").alias("group_size")))
    stays = F.when(F.col("first.doc_id").eqNullSafe(F.col("keep_id")), F.col("first.row"))
    return materialise(whole.join(index.plain(), "digest").select("digest", "keep_id", "group_size", stays.alias("row")))


def groups(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """Each row's group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space normalisation; null counts
    as empty, and all empty texts are one group. The row with the smallest
    doc_id stays, unless the index knew the text from earlier data with another
    id: then none of these does. Rows without an id come after all others; of
    rows with one id, or none, the first written stays, so exactly one row of a
    group does. ``group_size`` counts the rows of ``docs``. Columns of ``docs``
    other than doc_id and text are not read, so clashing names don't matter. An
    empty table gives an empty result. ``index`` may be dropped afterwards.
    """
    marks = docs.select("doc_id", F.unhex(digest(F.col("text"))).alias("digest"), F.monotonically_increasing_id().alias("row"))
    marks = materialise(marks, "digests")
    decided = _decided(marks, index, batches).withColumnRenamed("row", "stays")
    return marks.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("row").eqNullSafe(F.col("stays")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as there are shuffle partitions, for this session only."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, scratch(spark, "digest-index"), n)


def keep_first(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of each group of :func:`groups`, by the same rules.

    Any further columns are carried along, whatever their names. Rows and their
    digests are written once with a row number; the numbers that stay are
    unique, so the semi-join by them meets no hot key. It hashes those numbers,
    a few bytes a row, and sorts no text; they grow with the rows, so they are
    never broadcast.
    """
    name = fresh(docs, "digest_")
    table, row = numbered(docs, **{name: F.unhex(digest(F.col("text")))})
    marks = table.select("doc_id", F.col(name).alias("digest"), F.col(row).alias("row"))
    stays = _decided(marks, index, batches).where("row IS NOT NULL").select(F.col("row").alias(row))
    return table.join(stays.hint("shuffle_hash"), row, "left_semi").select(*plain_columns(docs))
