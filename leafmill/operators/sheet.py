"""Spreadsheet cells as pipe tables.

Cells are sparse rows. A grid is made dense by the gaps between neighbouring
cells and rows, so it costs what it prints and nothing is looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import format_cell, pipe_row, pipe_rule, strip

UNRESOLVED = "[unresolved formula]"
SHEET = ("doc_id", "sheet_ix")


def displayed(cells: DataFrame) -> DataFrame:
    """``cells`` with value, what each shows. A formula without a cached value is reported, never guessed."""
    unresolved = (F.col("kind") == "null") & F.coalesce(F.col("formula").startswith("="), F.lit(False))
    shown = format_cell(*(F.col(c) for c in ("kind", "num", "text", "ts", "bool", "number_format")))
    return cells.withColumn("value", F.when(unresolved, UNRESOLVED).otherwise(shown))


def merged_blanks(merges: DataFrame) -> DataFrame:
    """doc_id, sheet_ix, row, col of the positions in merged ranges, without the top left ones, which own the value."""
    rows = merges.select(*SHEET, "min_row", "min_col", "max_col", F.explode(F.sequence("min_row", "max_row")).alias("row"))
    every = rows.select(*SHEET, "min_row", "min_col", "row", F.explode(F.sequence("min_col", "max_col")).alias("col"))
    return every.where((F.col("row") != F.col("min_row")) | (F.col("col") != F.col("min_col"))).select(*SHEET, "row", "col").distinct()


def _filled(cells: Column, width: Column) -> Column:
    """Values of sorted (col, value) cells with blanks in the gaps and up to ``width``."""

    def one(c: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(cells, k - 1)["col"]).otherwise(0)
        return F.concat(F.array_repeat(F.lit(""), c["col"] - before - 1), F.array(c["value"]))

    tail = width - F.element_at(cells, -1)["col"]
    return F.concat(F.flatten(F.transform(cells, one)), F.array_repeat(F.lit(""), tail))


def last_rows(shown: DataFrame) -> DataFrame:
    """doc_id, sheet_ix, last_row (the last that isn't all blank; null without any) and width of each sheet."""
    full = F.when(F.col("value") != "", F.col("row"))
    return shown.groupBy(*SHEET).agg(F.max(full).alias("last_row"), F.max("col").alias("width"))


def sheets(cells: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """doc_id, sheet_ix, sheet, n_rows and table of each sheet that shows anything.

    ``cells``: doc_id, sheet_ix, sheet, row, col (from 1), kind (null, bool,
    num, date, text), num, text, ts, bool, number_format, formula. Blank rows
    at the end go, all others stay, and the first is the header. A sheet is as
    wide as its last cell or merged range.
    """
    shown = displayed(cells).select(*SHEET, "sheet", "row", "col", "value")
    if merges is not None:
        hidden = merged_blanks(merges).withColumn("hidden", F.lit(True))
        shown = shown.join(hidden, [*SHEET, "row", "col"], "left").withColumn("value", F.when(F.col("hidden"), "").otherwise(F.col("value")))
    whole, width = Window.partitionBy(*SHEET), F.lit(0)
    if merges is not None:
        shown = shown.join(merges.groupBy(*SHEET).agg(F.max("max_col").alias("merged")), [*SHEET], "left")
        width = F.coalesce("merged", F.lit(0))
    full = F.when(F.col("value") != "", F.col("row"))
    shown = shown.withColumns({"last_row": F.max(full).over(whole), "width": F.greatest(F.max("col").over(whole), width)}).where(F.col("row") <= F.col("last_row"))
    rows = shown.groupBy(*SHEET, "row", "width").agg(
        F.first("sheet").alias("sheet"), F.array_sort(F.collect_list(F.struct("col", "value"))).alias("cells")
    )
    gap = F.col("row") - F.coalesce(F.lag("row").over(Window.partitionBy(*SHEET).orderBy("row")), F.lit(0)) - 1
    rows = rows.withColumn("line", pipe_row(_filled(F.col("cells"), F.col("width")))).withColumn("gap", gap)
    table = rows.groupBy(*SHEET, "width").agg(
        F.first("sheet").alias("sheet"), F.max("row").alias("n_rows"), F.array_sort(F.collect_list(F.struct("row", "gap", "line"))).alias("rows")
    )
    blank = pipe_row(F.array_repeat(F.lit(""), F.col("width")))
    lines = F.flatten(F.transform("rows", lambda r: F.concat(F.array_repeat(blank, r["gap"]), F.array(r["line"]))))
    with_rule = F.concat(F.slice("lines", 1, 1), F.array(pipe_rule(F.col("width"))), F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1))))
    return table.withColumn("lines", lines).select(*SHEET, "sheet", "n_rows", F.array_join(with_rule, "\n").alias("table"))


def workbooks(cells: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """doc_id, md and error: sections of the sheets in order. Under ten characters is an error, and so is a workbook of blanks."""
    section = F.concat(F.lit("## "), "sheet", F.lit("\n\n"), "table")
    parts = sheets(cells, merges).select("doc_id", F.struct("sheet_ix", section.alias("md")).alias("p"))
    md = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["md"]), "\n\n")
    every = cells.select("doc_id").distinct().join(parts.groupBy("doc_id").agg(md.alias("md")), "doc_id", "left")
    text = F.coalesce("md", F.lit(""))
    return every.select("doc_id", text.alias("md"), F.when(F.length(strip(text)) < 10, "almost no output").alias("error"))
