"""Tables that are written once and read again, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, deleted at exit; without that setting only a local master has one."""
    sc = spark.sparkContext
    if sc.applicationId not in _FOLDERS:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        _FOLDERS[sc.applicationId] = f"{(shared or tempfile.mkdtemp(prefix='leafmill-')).rstrip('/')}/leafmill-{uuid.uuid4().hex}"
        atexit.register(_forget, spark, _FOLDERS[sc.applicationId])
    return _FOLDERS[sc.applicationId]


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the interpreter
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table that was written just now."""
    path = f"{folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
