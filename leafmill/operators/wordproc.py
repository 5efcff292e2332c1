"""Word-processor paragraphs, tables, headers and footers as Markdown, in document order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import escape_pipes, pipe_row, pipe_rule, strip


def cell_text(paragraphs: Column) -> Column:
    """A table cell's paragraphs on one line."""
    return escape_pipes(strip(F.array_join(paragraphs, " ", "")))


def table(rows: Column) -> Column:
    """Rows of cells as a pipe table as wide as its first row: short rows are filled up, long ones cut. '' without a header."""
    header = F.get(rows, F.lit(0))
    width = F.size(header)

    def line(cells: Column) -> Column:
        short = F.greatest(width - F.size(cells), F.lit(0))
        return pipe_row(F.slice(F.concat(cells, F.array_repeat(F.lit(""), short)), F.lit(1), width))

    below = F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows), F.lit(1))), line)
    lines = F.concat(F.array(pipe_row(header), pipe_rule(width)), below)
    return F.when(F.coalesce(width, F.lit(0)) > 0, F.array_join(lines, "\n")).otherwise("")


def paragraph(text: Column, style: Column) -> Column:
    """A paragraph with the hashes of its style; '' if it has no text."""
    body, name = strip(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(style, F.lit("")))
    prefix = (
        F.when((name == "title") | name.contains("heading 1"), "# ")
        .when(name.contains("heading 2"), "## ")
        .when(name.contains("heading 3"), "### ")
        .when(name.startswith("heading"), "#### ")
        .otherwise("")
    )
    return F.when(body == "", "").otherwise(F.concat(prefix, body))


def headers_footers(parts: DataFrame) -> DataFrame:
    """doc_id, nth, md of distinct headers and footers in order of section, header first.

    ``parts``: doc_id, section_ix, label (Header or Footer), linked, text.
    Linked ones are another section's and go; of equal texts the first stays,
    whatever its label.
    """
    used = parts.where(~F.coalesce("linked", F.lit(False))).withColumn("text", strip("text")).where("text != ''")
    order = ["section_ix", F.when(F.col("label") == "Header", 0).otherwise(1)]
    first = used.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(*order))).where("_n = 1")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)).alias("nth")
    return first.select("doc_id", nth, F.concat(F.lit("*"), "label", F.lit(": "), "text", F.lit("*")).alias("md"))


def item_markdown(items: DataFrame) -> DataFrame:
    """``items`` (doc_id, seq, kind paragraph or table, text, style, rows) with md; other kinds are '' and print nothing."""
    md = F.when(F.col("kind") == "paragraph", paragraph(F.col("text"), F.col("style"))).when(F.col("kind") == "table", table(F.col("rows")))
    return items.withColumn("md", F.coalesce(md, F.lit("")))


def documents(items: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """doc_id, md and error: headers and footers, a rule, then the items in order. Under 20 characters is an error."""
    pieces = item_markdown(items).select("doc_id", F.lit(1).alias("part"), F.col("seq").cast("long").alias("seq"), "md")
    if parts is not None:
        top = headers_footers(parts)
        rule = top.select("doc_id").distinct().select("doc_id", F.lit(0), F.lit(1 << 40), F.lit("---"))
        pieces = top.select("doc_id", F.lit(0).alias("part"), F.col("nth").cast("long").alias("seq"), "md").union(rule).unionByName(pieces)
    in_order = F.array_sort(F.collect_list(F.when(F.col("md") != "", F.struct("part", "seq", "md"))))
    text = F.array_join(F.transform(in_order, lambda p: p["md"]), "\n\n")
    whole = pieces.groupBy("doc_id").agg(text.alias("md"))
    return whole.select("doc_id", "md", F.when(F.length(strip("md")) < 20, "almost no output").alias("error"))
