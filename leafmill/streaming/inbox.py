"""A watched folder: files that arrive are converted, recorded and moved by outcome.

The checkpoint knows which files were taken, the ledger is written by batch
(a batch that runs again overwrites its own part), and moves come last and
can be repeated, so a crash at any point loses nothing and doubles nothing.
Files must arrive by an atomic rename.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.functions.text import extension, file_name, stem
from leafmill.operators.route import supported
from leafmill.plans.convert import office_files

#: Files of a batch: few where an arrival should be out soon, many where all that is there is worked off, as every batch has costs of its own.
SOON, AT_ONCE = 100, 10_000


def arrivals(spark: SparkSession, folder: str, files_per_batch: int = SOON) -> DataFrame:
    """Supported files of a folder's top level, those already there first; the engine's own artefacts are left alone."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .where(supported(F.col("path")))
        .withColumns({"doc_id": F.col("path"), "ext": extension("path"), "stem": stem("path")})
    )


def move(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file into a folder of any file system of Spark's; one of the same name is replaced, one that is gone is done."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(path), hadoop.Path(folder)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(source):
        return
    fs.mkdirs(target)
    to = hadoop.Path(target, source.getName())
    aside = hadoop.Path(target, f"{source.getName()}.{uuid.uuid4().hex}.replaced")
    before = fs.exists(to)
    if before and not fs.rename(to, aside):
        raise OSError(f"{to} can't be replaced")
    if not fs.rename(source, to):
        if before:
            fs.rename(aside, to)  # the earlier file is back where it was
        raise OSError(f"{source} can't be moved to {to}")
    if before:
        fs.delete(aside, False)


def _move_here(path: str, folder: str) -> None:
    """:func:`move` for files of a disk that all machines see, by the machine that runs it; Hadoop's checksum goes along."""
    path, folder = ("/" + x.removeprefix("file:").lstrip("/") for x in (path, folder))
    at, name = os.path.split(path)
    if not os.path.exists(path):
        return
    os.makedirs(folder, exist_ok=True)
    kept, sums = f"{folder}/{name}", (f"{at}/.{name}.crc", f"{folder}/.{name}.crc")
    if os.path.exists(sums[1]):
        os.remove(sums[1])
    if os.path.exists(sums[0]):
        os.replace(*sums)
    os.replace(path, kept)


def move_all(outcomes: DataFrame, folder: str) -> None:
    """Move files (doc_id, the path, and outcome) into ``folder``/outcome: on a shared disk the executors do it, else the driver, many at once."""
    spark = outcomes.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    rows = outcomes.select("doc_id", "outcome")
    if fs.getUri().getScheme() != "file":
        with ThreadPoolExecutor(32) as pool:
            for _ in pool.map(lambda r: move(spark, r["doc_id"], f"{folder}/{r['outcome']}"), rows.toLocalIterator()):
                pass
        return
    base = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(folder)).toString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, outcome in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _move_here(path, f"{base}/{outcome}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows.mapInArrow(each, "n long").count()


def watch(
    spark: SparkSession,
    folder: str,
    out: str,
    convert: Callable[[DataFrame], DataFrame] = office_files,
    files_per_batch: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Convert what arrives in ``folder``. Under ``out``: markdown (doc_id, name, md), ledger (doc_id, outcome, error), checkpoint.

    ``convert`` gives doc_id, md and error for files with content. Sources
    end in ``folder``/processed or ``folder``/failed. ``once`` ends the stream
    when all that is there is done; it runs in a session like ``spark``'s, and
    in batches of 10,000 files if not told otherwise, else 100.
    """

    def batch(files: DataFrame, number: int) -> None:
        results = convert(files)
        part = f"{out}/results/batch={number}"
        named = results.withColumns(
            {"name": F.concat(stem("doc_id"), F.lit(".md")), "outcome": F.when(F.col("error").isNull(), "processed").otherwise("failed")}
        )
        named.select("doc_id", "name", "md", "outcome", "error").write.mode("overwrite").parquet(part)
        move_all(results.sparkSession.read.parquet(part), folder)

    own = spark
    if once:  # a batch's files are listed by a task for each core, not by one for each file
        own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
        own.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.defaultParallelism)
    writer = arrivals(own, folder, files_per_batch or (AT_ONCE if once else SOON)).writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/checkpoint")
    return (writer.trigger(availableNow=True) if once else writer).start()


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, file, outcome, error and batch of every file so far."""
    return spark.read.option("basePath", f"{out}/results").parquet(f"{out}/results").select("doc_id", file_name("doc_id").alias("file"), "outcome", "error", "batch")


def markdown(spark: SparkSession, out: str) -> DataFrame:
    """name and md of every converted file; of files with one stem the last batch's stays, as it would on disk."""
    done = spark.read.option("basePath", f"{out}/results").parquet(f"{out}/results").where("outcome = 'processed'")
    return done.groupBy("name").agg(F.max_by("md", F.struct("batch", "doc_id")).alias("md"))
