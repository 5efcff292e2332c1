"""Quality rules by weak supervision, in DataFrame and SQL functions only.

Eight rules look at counts of a text and vote *good* (``g``), *bad* (``b``) or
abstain (``-``). Vote patterns are counted over all documents (at most 3**8
rows, whatever the corpus), expectation-maximisation over that table estimates
how far each rule can be trusted, and a document's posterior probability of
being good replaces the demand that every rule be met. No label is used.

The counts of a text come from arrays inside its own row, so there is no
shuffle, and a long text costs n log n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WS, fresh, materialise, plain_columns

RULES = ("symbols", "symbols_a_word", "word_length", "dup_lines", "repeats", "capitals", "length", "sentences")
ITERATIONS = 30
#: Ranges of P(votes good | good) and P(votes bad | bad). Rules seldom err on good documents, which fixes what
#: "good" means; a bad document may break one rule only. No single vote is beyond doubt.
GOOD, BAD = (0.6, 0.98), (0.05, 0.98)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")


@dataclass(frozen=True)
class QualityModel:
    """prior: of a good document; good[j]: P(rule j votes good | good, it votes); bad[j]: the same for bad."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{WS}+"), "")


def covered(ws: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash within one text: of a text of a
    million words, two different ones agree with a chance of 3 in 10 ** 8.
    Sorting (hash, position) puts equal windows side by side; the positions of those that have
    an equal neighbour, sorted again, each cover three words less the overlap
    with the next.
    """
    last = F.size(ws) - 3

    def repeated(s: Column) -> Column:
        def has_twin(x: Column, k: Column) -> Column:
            h = x["h"]
            before = F.when(k > 0, F.get(s, k - 1)["h"] == h).otherwise(False)
            return before | F.coalesce(F.get(s, k + 1)["h"] == h, F.lit(False))

        return F.sort_array(F.transform(F.filter(s, has_twin), lambda x: x["i"]))

    def length(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))

    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")),
    )
    found = let(F.sort_array(windows), lambda s: let(repeated(s), length))
    return F.when(last >= 0, found).otherwise(F.lit(0).cast("long"))


def removed(text: Column, characters: str) -> Column:
    """How many of the characters a text holds."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def counts(text: Column) -> Column:
    """A struct of COUNTS of a text; null counts as a text without words."""
    body = F.coalesce(text, F.lit(""))

    def of(ws: Column) -> Column:
        lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            removed(body, "#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            covered(ws).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            removed(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
            removed(body, ".!?").alias("n_marks"),
        )

    return let(words(body), of)


def votes(c: Column) -> Column:
    """The rules' votes on a struct of COUNTS, one character each, in the order of RULES."""

    def rule(bad: Column, good: Column) -> Column:
        return F.when(bad, "b").when(good, "g").otherwise("-")

    n, chars, lines = c["n_words"], c["word_chars"], c["n_lines"]
    return F.concat(
        rule(c["n_symbols"] * 20 > chars, c["n_symbols"] * 100 <= chars),
        rule(c["n_symbols"] * 4 > n, c["n_symbols"] * 50 <= n),
        rule((chars < 2 * n) | (chars > 14 * n), (chars >= 3 * n) & (chars <= 10 * n) & (n > 0)),
        rule(c["n_dup_lines"] * 10 > lines * 3, (c["n_dup_lines"] == 0) & (lines > 1)),
        rule(c["n_repeat_words"] * 10 > n * 3, (c["n_repeat_words"] * 10 < n) & (n > 2)),
        rule(c["n_capitals"] * 10 > chars * 4, (c["n_capitals"] * 100 < chars * 15) & (n > 0)),
        rule(n < 20, n >= 50),
        rule(((c["n_marks"] == 0) & (n > 30)) | (c["n_marks"] * 2 > n), (c["n_marks"] * 100 >= n) & (c["n_marks"] * 3 <= n) & (n > 0)),
    )


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (c["n_repeat_words"] * 100 > c["n_words"] * 50)


_EM = f"""
aggregate(sequence(1, {ITERATIONS}),
  named_struct('prior', 0.8D, 'good', array_repeat(0.9D, {len(RULES)}), 'bad', array_repeat(0.7D, {len(RULES)})),
  (m, step) -> element_at(transform(array(
      transform(patterns, p -> named_struct('votes', p.votes, 'n', p.n, 'r', p.n / (1D + exp(
        aggregate(sequence(1, {len(RULES)}), ln(1D - m.prior) - ln(m.prior), (s, j) -> s + CASE substring(p.votes, j, 1)
          WHEN 'g' THEN ln(1D - element_at(m.bad, j)) - ln(element_at(m.good, j))
          WHEN 'b' THEN ln(element_at(m.bad, j)) - ln(1D - element_at(m.good, j))
          ELSE 0D END)))))),
    e -> named_struct(
      'prior', least(greatest((1D + aggregate(e, 0D, (s, x) -> s + x.r)) / (2D + aggregate(e, 0D, (s, x) -> s + x.n)), 0.01D), 0.99D),
      'good', transform(sequence(1, {len(RULES)}), j -> least(greatest(
        (9D + aggregate(e, 0D, (s, x) -> s + IF(substring(x.votes, j, 1) = 'g', x.r, 0D)))
        / (10D + aggregate(e, 0D, (s, x) -> s + IF(substring(x.votes, j, 1) != '-', x.r, 0D))), {GOOD[0]}D), {GOOD[1]}D)),
      'bad', transform(sequence(1, {len(RULES)}), j -> least(greatest(
        (7D + aggregate(e, 0D, (s, x) -> s + IF(substring(x.votes, j, 1) = 'b', x.n - x.r, 0D)))
        / (10D + aggregate(e, 0D, (s, x) -> s + IF(substring(x.votes, j, 1) != '-', x.n - x.r, 0D))), {BAD[0]}D), {BAD[1]}D)))), 1))
"""


def fit(pattern: DataFrame) -> QualityModel:
    """Expectation-maximisation over the counted vote patterns in column ``votes``.

    An empty table gives the starting values, but for the pseudo-counts.
    """
    counted = pattern.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    table = counted.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    m = table.select(F.expr(_EM).alias("m")).first()["m"]
    return QualityModel(m["prior"], tuple(m["good"]), tuple(m["bad"]))


def posterior(votes: Column, model: QualityModel) -> Column:
    """Probability that a document with these votes is good."""
    from math import log

    odds = F.lit(log(1 - model.prior) - log(model.prior))
    for j, (g, b) in enumerate(zip(model.good, model.bad, strict=True), 1):
        v = F.substring(votes, j, 1)
        odds = odds + F.when(v == "g", log(1 - b) - log(g)).when(v == "b", log(b) - log(1 - g)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(odds))


def assess(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, COUNTS, votes, base_failed, quality (the posterior) and kept, a row for each row.

    Kept is false where the base rules fail (under 50 words, or over half of
    them in repeated 3-word windows), else whether the posterior reaches
    ``threshold``. The model is fitted to what the base rules leave. Null and empty texts have no words and fail; repeated rows
    are judged alike; an empty table gives an empty result; other columns of
    ``docs`` aren't read, so their names don't matter; of ties at the threshold all
    are kept. The counts are written once, so the texts are read once.
    """
    c = docs.select("doc_id", counts(F.col("text")).alias("c"))
    table = materialise(c.select("doc_id", "c.*", votes(F.col("c")).alias("votes"), base_failed(F.col("c")).alias("base_failed")))
    model = fit(table.where(~F.col("base_failed")).select("votes"))
    return table.withColumn("quality", posterior(F.col("votes"), model)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`assess` keeps, all columns.

    Null and empty texts go, as they have no words; repeated rows share one
    fate; rows without an id are judged like others; further columns are
    carried along, whatever their names; an empty table gives an empty result.
    Every text is counted once: rows are written with their votes, the model is
    fitted to those, and what is read again is filtered. Nothing is shuffled
    but counted vote patterns.
    """
    name = fresh(docs, "votes_")
    judged = let(counts(F.col("text")), lambda c: F.when(~base_failed(c), votes(c)))
    table = materialise(docs.withColumn(name, judged), "judged")
    model = fit(table.select(F.col(name).alias("votes")).where("votes IS NOT NULL"))
    return table.where(F.col(name).isNotNull() & (posterior(F.col(name), model) >= threshold)).select(*plain_columns(docs))
