"""Whole conversions: tables of pages, blocks, cells or items in, Markdown out, and the registry of all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators import anchor, assemble, classify, index, reconcile, sheet, spacing, wordproc
from leafmill.sources import office

Conversion = Callable[..., DataFrame]
_REGISTRY: dict[str, Conversion] = {}


def register(name: str) -> Callable[[Conversion], Conversion]:
    """Add a conversion, a function of DataFrames that returns doc_id, md and error, under a name."""

    def add(conversion: Conversion) -> Conversion:
        _REGISTRY[name] = conversion
        return conversion

    return add


def conversion(name: str) -> Conversion:
    if name not in _REGISTRY:
        raise KeyError(f"no conversion {name!r}; there are {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name]


@register("text")
def digital(chunks: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Chunks of digital documents, spacing repaired from page words (doc_id, page_number, seq, word), assembled and indexed."""
    if words is not None:
        lists = words.groupBy("doc_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("seq", "word"))).alias("w"))
        lists = lists.select("doc_id", "page_number", F.transform("w", lambda x: x["word"]).alias("words"))
        chunks = spacing.repair(chunks.join(lists, ["doc_id", "page_number"], "left"))
    whole = assemble.document(chunks)
    n = chunks.groupBy("doc_id").agg(F.count("*").alias("n"))
    short = classify.too_little(F.col("md"), F.col("n"))
    return whole.join(n, "doc_id").select("doc_id", "md", F.when(short, "little output").alias("warning"), F.lit(None).cast("string").alias("error"))


@register("ocr")
def scanned(primary: DataFrame, blocks: DataFrame, reference: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
    """Recognised texts (doc_id, md): reconciled with a second pass if there is one, then page markers and an index."""
    text = reconcile.reconcile(primary, reference, words).select("doc_id", "md") if reference is not None else primary
    marked = anchor.with_markers(text, blocks).select("doc_id", "md")
    ending = index.rendered(index.title_index(marked))
    whole = F.concat("md", F.coalesce("index_text", F.lit("")))
    return marked.join(ending, "doc_id", "left").select("doc_id", whole.alias("md"), F.lit(None).cast("string").alias("error"))


def _with_errors(converted: DataFrame, failed: DataFrame) -> DataFrame:
    """Results and unreadable files; a result that has an error keeps its text for inspection."""
    return converted.unionByName(failed.select("doc_id", F.lit(None).cast("string").alias("md"), "error"))


@register("xlsx")
def workbooks(binary: DataFrame) -> DataFrame:
    """Workbook files (doc_id, content)."""
    cells, merges, errors = office.read_workbooks(binary)
    return _with_errors(sheet.workbooks(cells, merges), errors)


@register("docx")
def documents(binary: DataFrame) -> DataFrame:
    """Word-processor files (doc_id, content)."""
    items, parts, errors = office.read_documents(binary)
    return _with_errors(wordproc.documents(items, parts), errors)


def office_files(files: DataFrame) -> DataFrame:
    """doc_id, md, error of routed files (doc_id, ext, content): each kind by its reader, others an error."""
    kinds = ("xlsx", "docx")
    done = [conversion(k)(files.where(F.col("ext") == k)) for k in kinds]
    other = files.where(~F.coalesce(F.col("ext").isin(*kinds), F.lit(False)))
    rest = other.select(F.col("doc_id").cast("string"), F.lit(None).cast("string").alias("md"), F.lit("no reader for this kind").alias("error"))
    return done[0].unionByName(done[1]).unionByName(rest)
