"""The driver's tables as pages, chunks, blocks, cells and items. The oracles do the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each document; every seventh has control characters in place of e."""
    bad = F.when(F.col("doc_id") % 7 == 0, F.translate("text", "e", "\x01")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("page_number"), bad.alias("text"), "source")


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each turn; those of every seventh conversation have control characters."""
    bad = F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") % 2 == 0), F.translate("text", "e", "\x01")).otherwise(F.col("text"))
    page = (F.col("turn") + 1).cast("int")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), page.alias("page_number"), bad.alias("text"))


def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk for each turn, under its role and its first 40 characters as headings."""
    flat = F.translate(F.substring("text", 1, 40), "\n", " ")
    text = F.concat(F.lit("# "), "role", F.lit("\n## "), flat, F.lit("\n\n"), "text")
    seq, page = F.col("turn").cast("int"), (F.col("turn") + 1).cast("int")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), seq.alias("seq"), page.alias("page_number"), text.alias("text"))


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block for each line of a document, five to a page."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    nothing = F.lit(None).cast("string").alias("table_body")
    return lines.select("doc_id", "seq", "text", nothing, F.floor(F.col("seq") / 5).cast("int").alias("page_idx"))


def document_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("md"))


def reference_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second pass over the documents, which reads every e as q."""
    return table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("e"), F.lit("q")).alias("md"))


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower-cased tokens of the benchmark, as a wordlist."""
    from leafmill.functions.text import TOKEN

    tokens = F.explode(F.regexp_extract_all("text", F.lit(TOKEN), 0))
    return table(spark, sf_dir, "benchmark").select(tokens.alias("word")).select(F.lower("word").alias("word")).distinct()


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four columns and fifty rows of customers to a sheet, twenty sheets to a workbook."""
    c = table(spark, sf_dir, "customer").withColumn("_k", F.col("c_custkey").cast("long"))
    null = lambda t: F.lit(None).cast(t)

    def cell(col, kind, num=None, text=None, number_format=None, formula=None):
        return F.struct(
            F.lit(col).alias("col"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
            (null("double") if num is None else num.cast("double")).alias("num"),
            (null("string") if text is None else text).alias("text"),
            (null("string") if number_format is None else F.lit(number_format)).alias("number_format"),
            (null("string") if formula is None else formula).alias("formula"),
        )

    blank = F.col("_k") % 11 == 3
    cells = F.array(
        cell(1, "num", F.col("c_custkey"), number_format="General"),
        cell(2, "text", text=F.concat("c_name", F.lit(" | "), "c_mktsegment")),
        cell(3, F.when(blank, "null").otherwise("num"), F.when(~blank, F.col("c_acctbal")), number_format="#,##0.00", formula=F.when(blank, "=B1*2")),
        cell(4, "num", F.col("c_acctbal"), number_format="0.00"),
    )
    at = c.select(
        F.floor(F.col("_k") / 1000).cast("long").alias("doc_id"),
        F.floor(F.col("_k") % 1000 / 50).cast("int").alias("sheet_ix"),
        (F.col("_k") % 50 + 1).cast("int").alias("row"),
        F.explode(cells).alias("c"),
    )
    return at.select(
        "doc_id",
        "sheet_ix",
        F.concat(F.lit("Sheet"), (F.col("sheet_ix") + 1).cast("string")).alias("sheet"),
        "row",
        "c.*",
        null("timestamp").alias("ts"),
        null("boolean").alias("bool"),
    )


def sheet_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One merged range of two rows and two columns in each sheet."""
    cells = customer_cells(spark, sf_dir).select("doc_id", "sheet_ix").distinct()
    first = (F.col("sheet_ix") % 5 + 1).cast("int")
    return cells.select("doc_id", "sheet_ix", first.alias("min_row"), F.lit(2).alias("min_col"), (first + 1).alias("max_row"), F.lit(3).alias("max_col"))


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings and paragraphs of web pages, in order."""
    found = F.regexp_extract_all("html", F.lit(r"(?s)<(?:h1|p)>(.*?)</(?:h1|p)>"), 0)
    items = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.posexplode(found).alias("seq", "raw"))
    head = F.col("raw").startswith("<h1>")
    return items.select(
        "doc_id",
        "seq",
        F.lit("paragraph").alias("kind"),
        F.regexp_replace("raw", r"^<(?:h1|p)>|</(?:h1|p)>$", "").alias("text"),
        F.when(head, "Heading 1").otherwise("Normal").alias("style"),
        F.lit(None).cast("array<array<string>>").alias("rows"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line number of an order, as the table repeats some."""
    largest = [F.max(c).alias(c) for c in ("l_partkey", "l_suppkey")]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*largest)
