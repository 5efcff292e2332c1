"""Page texts put together as one document with page markers between them, and what can be located in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import page_marker
from leafmill.operators import index


def offsets(chunks: DataFrame) -> DataFrame:
    """``chunks`` (doc_id, seq, page_number, text) with marker, start and stop (code points, stop exclusive) in their document.

    A chunk without page number has its ordinal, a null text is empty, and
    the first chunk has no marker.
    """
    inside = Window.partitionBy("doc_id").orderBy("seq")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_nth", F.row_number().over(inside))
    placed = placed.withColumn("page_number", F.coalesce("page_number", "_nth"))
    marker = F.when(F.col("_nth") > 1, F.concat(F.lit("\n\n"), page_marker("page_number"), F.lit("\n\n"))).otherwise("")
    size = (F.length("marker") + F.length("text")).cast("long")
    return (
        placed.withColumn("marker", marker)
        .withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("marker"))
        .withColumn("stop", F.col("start") + F.length("text"))
        .drop("_nth")
    )


def boxes(chunks: DataFrame, placed: DataFrame) -> DataFrame:
    """The boxes (class, bbox, pos) of ``chunks`` with their own text and their place in the document.

    ``placed`` is :func:`offsets` of the chunks, repaired or not: a box is cut
    from the text that its position belongs to. A box without position has
    neither text nor place.
    """
    at = placed.select("doc_id", "seq", "page_number", "start")
    rows = chunks.select("doc_id", "seq", "text", F.posexplode("boxes").alias("box_no", "box")).join(at, ["doc_id", "seq"])
    first, last = F.get("box.pos", 0), F.get("box.pos", 1)
    return rows.select(
        "doc_id",
        "seq",
        "box_no",
        F.col("box.class").alias("class"),
        F.col("box.bbox").alias("bbox"),
        F.expr("substring(text, box.pos[0] + 1, box.pos[1] - box.pos[0])").alias("text"),
        "page_number",
        F.when(first.isNotNull(), F.array(F.col("start") + first, F.col("start") + last)).alias("doc_pos"),
    )


def body(chunks: DataFrame) -> DataFrame:
    """doc_id and md: the chunks in order of seq, markers between them."""
    parts = offsets(chunks).select("doc_id", F.struct("seq", F.concat("marker", "text").alias("part")).alias("p"))
    joined = F.array_join(F.transform(F.array_sort("parts"), lambda p: p["part"]), "")
    return parts.groupBy("doc_id").agg(F.collect_list("p").alias("parts")).select("doc_id", joined.alias("md"))


def document(chunks: DataFrame) -> DataFrame:
    """doc_id and md: :func:`body` with the index of its headings at the end."""
    whole = body(chunks)
    ending = index.rendered(index.title_index(whole))
    return whole.join(ending, "doc_id", "left").select("doc_id", F.concat("md", F.coalesce("index_text", F.lit(""))).alias("md"))
