"""Page markers for a text without pages, from layout blocks that know theirs.

A document's blocks are looked for in order and only forward. Blocks whose text
occurs three times or more are boilerplate and anchor nothing, nor do blocks
with little text. All of a document's work is done in its own row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from leafmill.functions.text import strip

BOILERPLATE_REPEATS = 3
#: Characters of a text block and of a table that are looked for, and the fewest that are worth it.
TEXT_NEEDLE, TABLE_NEEDLE, SHORTEST = 40, 120, 10
BLOCKS = "array<struct<text:string,table_body:string,page_idx:int,bbox:array<double>>>"


def from_json(listed: DataFrame, column: str = "content_list") -> DataFrame:
    """doc_id, seq, text, table_body, page_idx, bbox of the blocks in a JSON list; a malformed or null list has none."""
    return listed.select("doc_id", F.posexplode(F.from_json(column, BLOCKS)).alias("seq", "b")).select("doc_id", "seq", "b.*")


def keyed(blocks: DataFrame) -> DataFrame:
    """``blocks`` with key (its text, else its table, stripped) and n, the blocks of its document with that key."""
    text, table = (F.coalesce(c, F.lit("")) for c in ("text", "table_body"))
    key = strip(F.when(text != "", text).otherwise(table))
    together = blocks.repartition("doc_id").withColumn("key", key)
    return together.withColumn("n", F.count("*").over(Window.partitionBy("doc_id", "key")))


def boilerplate(blocks: DataFrame, repeats: int = BOILERPLATE_REPEATS) -> DataFrame:
    """doc_id, key, n of repeated block texts."""
    return keyed(blocks).where((F.col("key") != "") & (F.col("n") >= repeats)).select("doc_id", "key", "n").distinct()


def needles(blocks: DataFrame, repeats: int = BOILERPLATE_REPEATS) -> DataFrame:
    """doc_id, seq, page_idx, needle of the blocks that can anchor."""
    text, table = strip(F.coalesce("text", F.lit(""))), strip(F.coalesce("table_body", F.lit("")))
    needle = F.when(text != "", F.substring(text, 1, TEXT_NEEDLE)).otherwise(F.substring(table, 1, TABLE_NEEDLE))
    usable = F.col("page_idx").isNotNull() & ~((F.col("key") != "") & (F.col("n") >= repeats))
    return keyed(blocks).where(usable).withColumn("needle", needle).where(F.length("needle") >= SHORTEST).select("doc_id", "seq", "page_idx", "needle")


def walk(md: str, found: list[dict]) -> list[tuple[int, int]]:
    """(position, page) of every change of page, by blocks (needle, page_idx) that are looked for in order and only forward."""
    cursor, page, marks = 0, None, []
    for block in found:
        at = md.find(block["needle"], cursor)
        if at >= 0:
            if page not in (None, block["page_idx"]):
                marks.append((at, block["page_idx"]))
            cursor, page = at + len(block["needle"]), block["page_idx"]
    return marks


def with_markers(md: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, md with a marker at each change of page, and n_markers. Without the markers it is ``md``, byte for byte.

    A document without blocks, or a null one, stays as it is. The search goes
    on from where the last block ended, which a string function of the JVM
    would have to count to from the start, so it runs in Arrow batches: linear
    in the text.
    """
    in_order = F.array_sort(F.collect_list(F.struct("seq", "page_idx", "needle")))
    joined = md.select("doc_id", "md").join(needles(blocks).groupBy("doc_id").agg(in_order.alias("found")), "doc_id", "left")
    schema = StructType([joined.schema["doc_id"], StructField("md", StringType()), StructField("n_markers", IntegerType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for text, found in zip(batch.column("md").to_pylist(), batch.column("found").to_pylist(), strict=True):
                marks = walk(text, found) if text and found else []
                ends = [a for a, _ in marks[1:]] + [None]
                parts = [f"\n\n<!-- page {page + 1} -->\n\n{text[at:end]}" for (at, page), end in zip(marks, ends, strict=True)] if marks else []
                texts.append("".join([text[: marks[0][0]], *parts]) if marks else text)
                numbers.append(len(marks))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(numbers, pa.int32())], schema.names)

    return joined.select("doc_id", "md", "found").mapInArrow(each, schema)


def marker_audit(marked: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, pages (by the largest page index; 1 without blocks), n_markers and missing, the changes of page that no marker stands for.

    Several missing markers mean that many blocks weren't found in the text.
    """
    most = blocks.groupBy("doc_id").agg(F.max("page_idx").alias("last"))
    pages = (F.coalesce("last", F.lit(0)) + 1).alias("pages")
    joined = marked.select("doc_id", "n_markers").join(most, "doc_id", "left").select("doc_id", pages, "n_markers")
    return joined.withColumn("missing", F.greatest(F.col("pages") - 1 - F.col("n_markers"), F.lit(0)))
