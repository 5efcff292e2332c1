"""Spelling drift between two passes over the same document.

A word of the dictionary is put back to a rare spelling only where both occur
repeatedly in the primary pass, both have as many letters and differ little,
and the reference pass has the rare spelling and never the dictionary's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import TOKEN

REPEATED, DISTANCE = 2, 2
#: A token and its repetitions among sorted ones; possessive, so that Java's stack doesn't grow with them.
_REPEATS = r"\b([A-Za-z]++)(?: \1\b)++"


def wordlist(spark, path: str) -> DataFrame:
    """Distinct lower-cased lines of text files, without blanks."""
    word = F.lower(F.trim("value"))
    return spark.read.text(path).select(word.alias("word")).where("word != ''").distinct()


def token_counts(md: DataFrame) -> DataFrame:
    """doc_id, token, n and first (the ordinal of its first occurrence).

    A text's tokens are sorted and counted in its own row, so nothing is
    shuffled and no task holds more than a text. Only where several rows have
    one doc_id, which is looked up first, their counts are added up.
    """
    tokens = md.select("doc_id", F.sort_array(F.transform(F.regexp_extract_all("md", F.lit(TOKEN), 0), lambda t, k: F.struct(t.alias("token"), k.alias("at")))).alias("s"))
    new = lambda k: (k == 0) | (F.get("s", k)["token"] != F.get("s", k - 1)["token"])
    begins = tokens.select("doc_id", "s", F.filter(F.transform("s", lambda _, k: k), new).alias("b"))  # no condition on s, which would be made again for it
    n = lambda b, k: (F.coalesce(F.get("b", k + 1), F.size("s")) - b).cast("long")
    row = F.transform("b", lambda b, k: F.struct(F.get("s", b)["token"].alias("token"), n(b, k).alias("n"), F.get("s", b)["at"].alias("first")))
    counts = begins.select("doc_id", F.inline(row))
    if _one_row_each(md):
        return counts
    return counts.groupBy("doc_id", "token").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def _one_row_each(md: DataFrame) -> bool:
    return md.groupBy("doc_id").count().where("count > 1").isEmpty()


def _repeats(tokens: str, group: int) -> Column:
    """Tokens that occur twice or more, sorted: each once (group 1), or as often as it occurs, between spaces (group 0)."""
    return F.regexp_extract_all(F.array_join(F.sort_array(tokens), " "), F.lit(_REPEATS), group)


def repeated_counts(md: DataFrame) -> DataFrame:
    """doc_id, token and n of the tokens that occur twice or more, without a shuffle where ids are unique."""
    if not _one_row_each(md):
        return token_counts(md).where(F.col("n") >= REPEATED).drop("first")
    tokens = md.select("doc_id", F.regexp_extract_all("md", F.lit(TOKEN), 0).alias("tokens"))
    runs = tokens.select("doc_id", F.explode(_repeats("tokens", 0)).alias("run")).select("doc_id", "run", F.substring_index("run", " ", 1).alias("token"))
    return runs.select("doc_id", "token", F.floor((F.length("run") + 1) / (F.length("token") + 1)).cast("long").alias("n"))


def repeated_tokens(md: DataFrame) -> DataFrame:
    """doc_id, token and first (what is smaller occurs earlier) of the tokens that occur twice or more, likewise."""
    if not _one_row_each(md):
        return token_counts(md).where(F.col("n") >= REPEATED).drop("n")
    tokens = md.select("doc_id", F.regexp_extract_all("md", F.lit(TOKEN), 0).alias("tokens"))
    return tokens.select("doc_id", F.posexplode(F.array_intersect("tokens", _repeats("tokens", 1))).alias("first", "token"))


def rare_tokens(counts: DataFrame, words: DataFrame) -> DataFrame:
    """Repeated tokens that the wordlist lacks."""
    return counts.where(F.col("n") >= REPEATED).join(words, F.lower("token") == F.col("word"), "left_anti")


def dictionary_tokens(counts: DataFrame, words: DataFrame) -> DataFrame:
    """Repeated tokens that the wordlist has."""
    return counts.where(F.col("n") >= REPEATED).join(words, F.lower("token") == F.col("word"), "left_semi")


def twins(repeated: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, rare_token, dict_token, first, dict_first: pairs of equal length and at most two edits apart.

    Repeated tokens alone are dealt by document and length, once, and meet
    those of their own group.
    """
    known = words.select(F.col("word").alias("_word")).distinct()
    tokens = repeated.where(F.col("doc_id").isNotNull()).join(known, F.lower("token") == F.col("_word"), "left")
    token, rare = F.struct("token", "first"), F.col("_word").isNull()
    groups = tokens.groupBy("doc_id", F.length("token").alias("size")).agg(F.collect_list(F.when(rare, token)).alias("rare"), F.collect_list(F.when(~rare, token)).alias("dict"))
    pairs = groups.where((F.size("rare") > 0) & (F.size("dict") > 0)).select("doc_id", F.explode("rare").alias("r"), "dict").select("doc_id", "r", F.explode("dict").alias("d"))
    near = F.levenshtein(F.lower("r.token"), F.lower("d.token"), DISTANCE).between(0, DISTANCE)
    found = pairs.where(near)
    return found.select("doc_id", F.col("r.token").alias("rare_token"), F.col("d.token").alias("dict_token"), F.col("r.first").alias("first"), F.col("d.first").alias("dict_first"))


def _confirmed(primary: DataFrame, reference: DataFrame, words: DataFrame) -> DataFrame:
    """:func:`confirmed` with n_reference, how often the reference pass has the rare spelling."""
    pairs = twins(repeated_tokens(primary), words).groupBy("doc_id").agg(F.collect_list(F.struct("first", "rare_token", "dict_token")).alias("pairs"))
    met = reference.select("doc_id", "md").join(pairs.hint("shuffle_hash"), "doc_id")  # the pairs are held, texts pass by unsorted
    tokens = met.select("doc_id", "pairs", F.regexp_extract_all("md", F.lit(TOKEN), 0).alias("tokens"))
    known = F.array_intersect("tokens", F.concat("pairs.rare_token", "pairs.dict_token"))
    both = tokens.select("doc_id", "pairs", "tokens", known.alias("known")).select("doc_id", "tokens", "known", F.explode("pairs").alias("p")).select("doc_id", "p.*", "tokens", "known")
    has = lambda token: F.array_contains("known", F.col(token))
    times = F.size("tokens") - F.size(F.array_remove("tokens", F.col("rare_token")))
    n = F.when(has("rare_token") & ~has("dict_token"), times).otherwise(0)
    looked = both.select("doc_id", "rare_token", "dict_token", "first", n.alias("n"), has("rare_token").alias("has_rare"), has("dict_token").alias("has_dict"))
    seen = looked.groupBy("doc_id", "rare_token", "dict_token", "first").agg(F.sum("n").alias("n_reference"), F.max("has_rare").alias("has_rare"), F.max("has_dict").alias("has_dict"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "dict_token").orderBy("first", "rare_token"))
    return seen.where("has_rare AND NOT has_dict").withColumn("nth", nth).where("nth = 1").select("doc_id", "dict_token", "rare_token", "n_reference")


def confirmed(primary: DataFrame, reference: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, dict_token, rare_token of the corrections; of several rare twins the one that occurs first wins."""
    return _confirmed(primary, reference, words).drop("n_reference")


def _whole_word(token: Column) -> Column:
    """Pattern of a token between word boundaries; it begins with letters, which Java finds without trying every place."""
    return F.concat(F.lit("(?U)"), token, F.lit(r"(?<=\b"), token, F.lit(r")\b"))


def change_log(primary: DataFrame, reference: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, dict_token, rare_token, n_replaced, n_reference of every correction that changes the text.

    ``n_replaced`` counts the whole words that give way, ``n_reference`` how
    often the reference pass has the rare spelling.
    """
    word = _whole_word(F.col("dict_token"))
    met = primary.select("doc_id", "md").join(_confirmed(primary, reference, words).hint("shuffle_hash"), "doc_id").where(F.rlike("md", word))
    return met.select("doc_id", "dict_token", "rare_token", F.regexp_count("md", word).alias("n_replaced"), "n_reference")


def reconcile(primary: DataFrame, reference: DataFrame, words: DataFrame | None) -> DataFrame:
    """doc_id, md and n_replaced of ``primary`` (doc_id, md); without a wordlist nothing is changed."""
    if words is None:
        return primary.select("doc_id", "md", F.lit(0).alias("n_replaced"))
    pairs = confirmed(primary, reference, words).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("dict_token", "rare_token"))).alias("pairs"))
    joined = primary.select("doc_id", "md").join(pairs.hint("shuffle_hash"), "doc_id", "left")
    text = F.aggregate("pairs", F.col("md"), lambda s, p: F.regexp_replace(s, _whole_word(p["dict_token"]), p["rare_token"]))
    n = F.aggregate("pairs", F.lit(0), lambda total, p: total + F.regexp_count(F.col("md"), _whole_word(p["dict_token"])))
    counted = joined.withColumn("n_replaced", F.coalesce(n, F.lit(0)))  # before md has another meaning
    return counted.select("doc_id", F.coalesce(text, "md").alias("md"), "n_replaced")
