"""Pages and documents by whether their text layer can be trusted.

A page needs optical recognition for one reason at most, the first that holds:
too little text, too many control characters, images over much of its area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import control_ratio, strip


def image_coverage(images: Column, width: Column, height: Column) -> Column:
    """Share of a page under placed images, each clipped to the page; overlaps count twice, 1 is the most, 0 without area."""
    area = width * height

    def clipped(r: Column) -> Column:
        across = F.greatest(F.least(r["x1"], width) - F.greatest(r["x0"], F.lit(0.0)), F.lit(0.0))
        down = F.greatest(F.least(r["y1"], height) - F.greatest(r["y0"], F.lit(0.0)), F.lit(0.0))
        return across * down

    covered = F.aggregate(images, F.lit(0.0), lambda total, r: total + clipped(r))
    return F.when(area > 0, F.least(F.coalesce(covered, F.lit(0.0)) / area, F.lit(1.0))).otherwise(0.0)


def page_reasons(
    pages: DataFrame,
    min_page_chars: int = 20,
    garbage_char_ratio: float = 0.05,
    image_coverage_threshold: float = 0.5,
    by_count_only: bool = False,
) -> DataFrame:
    """``pages`` with chars (of the stripped text) and reason: image_only, garbage, image_heavy or null.

    Columns read: text and, where they are there, images, page_w and page_h. A
    null text is empty. ``by_count_only`` leaves out all but the first reason.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    reason = F.when(F.length(strip(text)) < min_page_chars, "image_only")
    if not by_count_only:
        reason = reason.when(control_ratio(text) > garbage_char_ratio, "garbage")
        if "images" in pages.columns:
            heavy = image_coverage(F.col("images"), F.col("page_w"), F.col("page_h")) > image_coverage_threshold
            reason = reason.when(heavy, "image_heavy")
    return pages.withColumns({"chars": F.length(strip(text)).cast("long"), "reason": reason})


def classify(pages: DataFrame, **limits) -> DataFrame:
    """A row for each doc_id: page_count, total_chars, and the page numbers of each reason, in order."""

    def numbers(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, F.col("page_number"))))

    return (
        page_reasons(pages, **limits)
        .select("doc_id", "page_number", "chars", "reason")
        .groupBy("doc_id")
        .agg(
            F.count("*").cast("int").alias("page_count"),
            F.sum("chars").alias("total_chars"),
            numbers(F.col("reason").isNotNull()).alias("needs_ocr"),
            numbers(F.col("reason") == "garbage").alias("garbage"),
            numbers(F.col("reason") == "image_heavy").alias("image"),
        )
    )


def ocr_ratio(needing: Column, pages: Column) -> Column:
    """Share of pages that need recognition; 1 where there are no pages."""
    return F.coalesce(F.try_divide(needing, pages), F.lit(1.0))


def verdict(classified: DataFrame, image_threshold: float = 0.2) -> DataFrame:
    """``classified`` with ratio and verdict: scan if any page is garbage or the ratio is over the threshold, else digital."""
    ratio = ocr_ratio(F.size("needs_ocr"), F.col("page_count"))
    scan = (F.size("garbage") > 0) | (F.col("ratio") > image_threshold)
    return classified.withColumn("ratio", ratio).withColumn("verdict", F.when(scan, "scan").otherwise("digital"))


def too_little(body: Column, page_count: Column, min_page_chars: int = 20) -> Column:
    """Whether a converted text is so short that something was lost: a warning, never an error."""
    return F.length(strip(body)) < F.lit(min_page_chars) * F.greatest(page_count, F.lit(1)) * F.lit(0.2)
