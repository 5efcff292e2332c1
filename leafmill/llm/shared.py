"""Helpers that several training-data operators share.

* shared-storage scratch space (never a machine-local folder on a cluster),
* the *vocabulary kernel*: an Arrow batch of texts becomes one integer per
  word plus the batch's distinct words, so Python work is done once per
  distinct word and spread to occurrences by numpy.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract: space and U+0009 to U+000D.
WS = r"[\x20\x09-\x0D]"
#: Characters of text that one kernel call holds at most, unless one text is longer.
SLICE_CHARS = 8_000_000
#: Smallest number of partitions that a Python stage is cut into, per core.
TASKS_PER_CORE = 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a temporary folder; a
    cluster is an error, as no folder of one machine would do.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="leafmill-"))
        current = sc._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


#: Folders of intermediate tables by application, each made at its first use and deleted at exit.
_SCRATCH: dict[str, str] = {}
#: Intermediate tables, with the scope that they were made in.
_MADE: list[tuple[str, str]] = []
_SCOPE: list[str] = [""]


@contextlib.contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables made in here belong to ``name``, or to the scope around this one; :func:`sweep` deletes those of its own scope."""
    _SCOPE.append(_SCOPE[-1] or name)
    try:
        yield
    finally:
        _SCOPE.pop()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below this application's own folder in the shared one."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{shared_dir(spark)}/leafmill-{app}-{uuid.uuid4().hex}"
        atexit.register(_forget, spark, app)
    path = f"{_SCRATCH[app]}/{label}-{uuid.uuid4().hex}"
    _MADE.append((_SCOPE[-1], path))
    return path


def _forget(spark: SparkSession, app: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the interpreter
        drop_path(spark, _SCRATCH[app])


def _folders(tables: tuple[DataFrame, ...]) -> set[str]:
    """Names of the folders that tables are read from; their files, which may be very many, aren't listed."""
    found = set()
    for df in tables:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        for k in range(leaves.size()):
            leaf = leaves.apply(k)
            if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                found |= {p.rstrip("/").rpartition("/")[2] for p in leaf.relation().location().rootPaths().mkString("\n").split("\n")}
    return found


def sweep(spark: SparkSession, *needed: DataFrame) -> None:
    """Delete the intermediate tables of this scope, but for those that ``needed`` read.

    For when all results that rest on the others have been written.
    """
    kept = _folders(needed)
    _drop(spark, [x for x in _MADE if x[0] == _SCOPE[-1] and x[1].rpartition("/")[2] not in kept])


def drop_tables(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete intermediate tables that :func:`materialise` returned and nothing reads any more."""
    gone = _folders(tables)
    _drop(spark, [x for x in _MADE if x[1].rpartition("/")[2] in gone])


def _drop(spark: SparkSession, made: list[tuple[str, str]]) -> None:
    for x in made:
        drop_path(spark, x[1])
        _MADE.remove(x)


def materialise(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table that was written.

    This cuts the lineage: a lost executor can't change what was written, and
    nothing before it runs twice.
    """
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def plain_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by their whole names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def numbered(docs: DataFrame, **more: Column) -> tuple[DataFrame, str]:
    """``docs`` with columns ``more`` and a row number, written once, and that column's name.

    Row numbers tell rows with one id or none apart; as they are written, every
    later read has the same.
    """
    row = fresh(docs, "row_number_")
    return materialise(docs.withColumns(more | {row: F.monotonically_increasing_id()}), "numbered"), row


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the key's text, modulo ``modulus``, is ``remainder``."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(modulus) == F.lit(remainder)


def vocabulary_file(name: str) -> str:
    """Place of a public tokenizer's vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def local_file(path: str) -> str:
    """``path``, or, where it is a bare file name, its place among the public tokenizers."""
    return path if "/" in path or Path(path).exists() else vocabulary_file(path)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` bytes of text, one row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of every text, as (row offsets, word numbers, distinct words).

    ``offsets`` has one entry more than there are texts; words are maximal runs
    without white space; a null text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        before = np.concatenate(([0], np.cumsum(full)))
        offsets, ids = before[offsets], ids[full]
    return offsets, ids.astype(np.int64), coded.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row's stretch; 0 for an empty one."""
    run = np.concatenate((np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)))
    return run[offsets[1:]] - run[offsets[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + lengths[i] - 1``, one stretch after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def spread(df: DataFrame) -> DataFrame:
    """Rows in enough partitions for the cores, when a small table came in fewer files.

    A scan of a large table is split by Spark already and is left as it is.
    """
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism * TASKS_PER_CORE
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def ascii_lower(column: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
LOWER_TABLE = _UPPER.tobytes()


def lower_bytes(words: list[str]) -> list[bytes]:
    """UTF-8 of words with A to Z lower-cased; other letters keep their case."""
    return [w.encode().translate(LOWER_TABLE) for w in words]
