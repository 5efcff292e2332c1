"""Which way a file goes, which of its artefacts is taken, and how two results differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import extension, file_name, stem

OWN_ARTEFACT = r"(?i)\.(derotated|fromdoc|fromxls)\.pdf\z"
SUPPORTED = r"(?i)\.(pdf|docx|xlsx|doc|xls)\z"


def supported(path: Column) -> Column:
    """Whether a file is taken in: of a known kind and not made by the engine itself."""
    return path.rlike(SUPPORTED) & ~path.rlike(OWN_ARTEFACT)


def route(files: DataFrame) -> DataFrame:
    """``files`` (path, and where known verdict and engine, a forced one) with ext, stem, next_name, engine and error.

    Structured formats go straight to their readers, old ones to a conversion
    that comes back as next_name, and a PDF by its verdict or by force. Errors
    are values: a bad file never ends a batch.
    """
    given = {c: F.col(c) if c in files.columns else F.lit(None).cast("string") for c in ("verdict", "engine")}
    ext, forced = extension("path"), given["engine"]
    direct, old = ext.isin("docx", "xlsx"), ext.isin("doc", "xls")
    by_verdict = F.when(given["verdict"] == "digital", "text").when(given["verdict"] == "scan", "ocr")
    engine = F.when(direct & forced.isNull(), ext).when(old & forced.isNull(), "legacy").when(ext == "pdf", F.coalesce(forced, by_verdict, F.lit("classify")))
    error = (
        F.when(~ext.isin("pdf", "docx", "xlsx", "doc", "xls"), "unsupported extension")
        .when((direct | old) & forced.isNotNull(), "engine applies to pdf only")
        .when((ext == "pdf") & forced.isNotNull() & ~F.coalesce(forced.isin("text", "ocr"), F.lit(False)), "unknown engine")
        .when((ext == "pdf") & forced.isNull() & given["verdict"].isNotNull() & by_verdict.isNull(), "unexpected verdict")
    )
    converted = F.when(old & forced.isNull(), F.concat(stem("path"), F.lit(".from"), ext, F.lit(".pdf")))
    return files.withColumns(
        {"ext": ext, "stem": stem("path"), "next_name": converted, "engine": F.when(error.isNull(), engine), "error": error}
    )


def output_inside(output: Column, directory: Column) -> Column:
    """Whether an output path lies below the input's directory."""
    return output.startswith(F.concat(F.rtrim(directory, F.lit("/")), F.lit("/")))


def pick_artefact(artefacts: DataFrame) -> DataFrame:
    """doc_id, path, size: a document's artefact (doc_id, stem, path, size) named after it, else the largest; ties by path, then size."""
    best = F.when(F.regexp_replace(file_name("path"), r"(?s)(.)\.[^.]*\z", "$1") == F.col("stem"), 1).otherwise(0)
    ranked = F.max_by(F.struct("path", "size"), F.struct(best, F.when(best == 0, F.col("size")).otherwise(0), F.col("path"), F.col("size")))
    return artefacts.groupBy("doc_id").agg(ranked.alias("a")).select("doc_id", "a.path", "a.size")


def image_links(md: Column, folder: Column) -> Column:
    """Links to images/ led to the document's own folder below it."""
    return F.replace(md, F.lit("](images/"), F.concat(F.lit("](images/"), folder, F.lit("/")))


def model_available(names: Column, model: Column) -> Column:
    """Whether a list has the model's name, with its tag or without."""
    return F.exists(names, lambda n: (n == model) | (F.substring_index(n, ":", 1) == F.substring_index(model, ":", 1)))


def diff(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """key, left_value, right_value, outcome (same, changed, left_only, right_only) of two results."""
    a = left.select(key, F.col(value).alias("left_value"), F.lit(True).alias("_l"))
    b = right.select(key, F.col(value).alias("right_value"), F.lit(True).alias("_r"))
    outcome = (
        F.when(F.col("_r").isNull(), "left_only")
        .when(F.col("_l").isNull(), "right_only")
        .when(F.col("left_value").eqNullSafe(F.col("right_value")), "same")
        .otherwise("changed")
    )
    return a.join(b, key, "full_outer").select(key, "left_value", "right_value", outcome.alias("outcome"))
