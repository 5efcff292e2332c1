"""Page rotation that is corrected only where a second look confirms it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(observed: DataFrame, rechecks: DataFrame, min_confidence: float = 1.0) -> DataFrame:
    """status (fixed, unresolved, untouched) and degrees of each observed page.

    ``observed``: doc_id, page_number, applied_rotation (the page's own), rotate
    and conf (null: no text to orient). ``rechecks``: doc_id, page_number,
    applied_rotation, rotate, what is seen with that rotation. A page that
    looks turned has two candidates, one for each sign, or a single one; the
    smallest that is seen upright is applied. If there is none the page stays
    as it is and is reported. Both sides join on the page, so nothing but a
    page's few rows meets in one place.
    """
    turned = (F.coalesce("rotate", F.lit(0)) != 0) & (F.coalesce("conf", F.lit(0.0)) >= min_confidence)
    either = F.array(
        F.pmod(F.col("applied_rotation") + F.col("rotate"), F.lit(360)), F.pmod(F.col("applied_rotation") - F.col("rotate"), F.lit(360))
    )
    page = ("doc_id", "page_number")
    upright = rechecks.where(F.col("rotate") == 0).groupBy(*page).agg(F.collect_set("applied_rotation").alias("upright"))
    chosen = F.array_min(F.array_intersect(either, F.coalesce("upright", F.array().cast("array<int>"))))
    return (
        observed.withColumn("turned", turned)
        .join(upright, [*page], "left")
        .withColumn("degrees", F.when(F.col("turned"), chosen).cast("int"))
        .select(
            *page,
            F.when(~F.col("turned"), "untouched").when(F.col("degrees").isNotNull(), "fixed").otherwise("unresolved").alias("status"),
            "degrees",
            "rotate",
            "conf",
        )
    )


def summary(resolved: DataFrame) -> DataFrame:
    """doc_id, n_fixed, n_unresolved and unresolved (their page numbers in order) of :func:`resolve`'s pages."""
    of = lambda status: F.count_if(F.col("status") == status)
    left = F.array_sort(F.collect_list(F.when(F.col("status") == "unresolved", F.col("page_number"))))
    return resolved.groupBy("doc_id").agg(of("fixed").alias("n_fixed"), of("unresolved").alias("n_unresolved"), left.alias("unresolved"))
