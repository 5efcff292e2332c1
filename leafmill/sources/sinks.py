"""What the engine writes: Markdown files, block lists as JSON, and side files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import stem


def write_markdown(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """doc_id and md as a Parquet table, partition files by Spark's own split."""
    results.select("doc_id", "md").write.mode(mode).parquet(path)


def write_block_lists(blocks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON list of blocks a document, in order of seq; characters beyond ASCII stay as they are."""
    block_lists(blocks).write.mode(mode).parquet(path)


def block_lists(blocks: DataFrame) -> DataFrame:
    """doc_id and content_list, the JSON list of a document's blocks."""
    fields = [c for c in blocks.columns if c not in ("doc_id", "seq")]
    in_order = F.array_sort(F.collect_list(F.struct("seq", F.struct(*fields).alias("b"))))
    return blocks.groupBy("doc_id").agg(F.to_json(F.transform(in_order, lambda x: x["b"])).alias("content_list"))


def write_markdown_files(results: DataFrame, root: str) -> DataFrame:
    """Write md of each row (doc_id, md) as ``root``/stem.md in UTF-8; returns path and length of each. Rows without a text, as failures have, write none.

    Documents with one stem write one file, the last of them, as on a disk.
    """
    files = results.where("md IS NOT NULL").select(F.lit("").alias("folder"), F.concat(stem("doc_id"), F.lit(".md")).alias("name"), F.col("md").cast("binary").alias("content"))
    return write_files(files, root)


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Write content (binary) of each row to root/folder/name on any file system of Spark's; returns path and length of each.

    A row's file is written whole or not at all and replaces one of the same
    name, so a task that runs again does no harm.
    """
    from collections.abc import Iterator

    import pyarrow as pa
    from pyarrow import fs

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        for batch in batches:
            out = []
            for folder, name, content in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                place = f"{base}/{folder}".rstrip("/")
                store.create_dir(place, recursive=True)
                part = f"{place}/.{uuid.uuid4().hex}.part"  # two attempts of one task don't meet, and no reader sees what one that ended left
                with store.open_output_stream(part) as f:
                    f.write(content or b"")
                store.move(part, f"{place}/{name}")
                out.append((f"{place}/{name}", len(content or b"")))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], ["path", "length"])

    return rows.select("folder", "name", "content").mapInArrow(each, "path string, length long")
