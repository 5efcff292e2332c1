"""An index of a document's headings by page, without running headers.

Lines are filtered inside their own row, so only headings and page markers are
shuffled, never a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import HEADING, PAGE_MARKER, strip

#: First headings of a page that occur so often in a document are running headers.
BANNER_REPEATS = 3


def lines(md: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and line of every line of column ``md``."""
    return md.select("doc_id", F.posexplode(F.split("md", "\n")).alias("line_no", "line"))


def tagged_lines(md: DataFrame) -> DataFrame:
    """:func:`lines` with the page that each stands on: that of the last marker before it, 1 before any."""
    inside = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    number = F.regexp_extract(strip("line"), PAGE_MARKER, 1)
    mark = F.when(number != "", number.cast("int"))
    return lines(md).withColumn("page", F.coalesce(F.last(mark, ignorenulls=True).over(inside), F.lit(1)))


def headings(md: DataFrame) -> DataFrame:
    """doc_id, line_no, level, text, page and is_first_on_page of every heading with a text, banners included."""
    entries = F.transform(F.split("md", "\n"), lambda x, k: F.struct(k.alias("line_no"), strip(x).alias("line")))
    wanted = F.filter(entries, lambda e: e["line"].rlike(r"^(#{1,6}(?U)\s|<!-- page \d+ -->)"))
    found = md.select("doc_id", F.explode(wanted).alias("e")).select("doc_id", "e.line_no", "e.line")
    number = F.regexp_extract("line", PAGE_MARKER, 1)
    found = found.select(
        "doc_id",
        "line_no",
        F.when(number != "", number.cast("int")).alias("mark"),
        F.length(F.regexp_extract("line", HEADING, 1)).alias("level"),
        strip(F.replace(F.regexp_extract("line", HEADING, 2), F.lit("*"), F.lit(""))).alias("text"),
    ).where(F.col("mark").isNotNull() | (F.col("text") != ""))
    up_to = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    paged = found.withColumns({"page": F.coalesce(F.last("mark", ignorenulls=True).over(up_to), F.lit(1)), "segment": F.count("mark").over(up_to)})
    # A page number may come again, so a page is a stretch between two markers.
    nth = F.row_number().over(Window.partitionBy("doc_id", "segment").orderBy("line_no"))
    return paged.where("mark IS NULL").withColumn("is_first_on_page", nth == 1).select("doc_id", "line_no", "level", "text", "page", "is_first_on_page")


def banners(found: DataFrame, repeats: int = BANNER_REPEATS) -> DataFrame:
    """doc_id, text and n of the texts that are a page's first heading ``repeats`` times or more."""
    return found.where("is_first_on_page").groupBy("doc_id", "text").agg(F.count("*").alias("n")).where(F.col("n") >= repeats)


def title_index(md: DataFrame, repeats: int = BANNER_REPEATS, strict: bool = False) -> DataFrame:
    """doc_id, line_no, level, text, page: the headings whose text isn't a banner.

    ``strict`` drops a banner only where it stands first on its page.
    """
    found = headings(md)
    same = Window.partitionBy("doc_id", "text")
    n = F.count(F.when(F.col("is_first_on_page"), 1)).over(same)
    drop = (F.col("n") >= repeats) & F.col("is_first_on_page") if strict else F.col("n") >= repeats
    return found.withColumn("n", n).where(~drop).select("doc_id", "line_no", "level", "text", "page")


def rendered(entries: DataFrame) -> DataFrame:
    """doc_id and index_text: one comment block of a document's entries. A document without entries has no row."""
    line = F.concat(F.repeat(F.lit("  "), F.col("level") - 1), F.lit("- "), "text", F.lit(" (page "), F.col("page").cast("string"), F.lit(")"))
    in_order = F.transform(F.array_sort("entries"), lambda e: e["line"])
    return (
        entries.select("doc_id", F.struct("line_no", line.alias("line")).alias("e"))
        .groupBy("doc_id")
        .agg(F.collect_list("e").alias("entries"))
        .select("doc_id", F.concat(F.lit("\n\n<!-- document index\n"), F.array_join(in_order, "\n"), F.lit("\n-->\n")).alias("index_text"))
    )
