"""URL filters: longest-match rules first, then naive Bayes on segmented names.

Host names and paths run words together. A unigram Viterbi splits them, with
the word counts of the pages' visible text; multinomial naive Bayes over the
words of host and path, learned from the URLs that a rule judges, judges those
that none fits.

Everything is a table of distinct things: a run of letters is segmented once,
and the counts that it needs come by an equi-join of its substrings with all
word counts, so no vocabulary, lexicon or model is held in one place or cut to
a size. What one row sends for a Viterbi is bounded by its run's own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, materialise

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Words of which a host's segmentation has one feature more, whatever the word; they are known to the Viterbi.
SEEDS = frozenset("spam adult porn xxx casino bet bets poker pills viagra cheap loan escort warez track tracker malware phish".split())
#: What a letter of an unknown word costs, in natural logarithms.
LETTER = 2.5
_RUN = r"[a-z]+|[0-9]+|[^\x00-\x7F]+"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or no ://: empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; null or no ://: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, of equally long ones the first by name; null if none fits."""
    name = verdict = F.lit(None).cast("string")
    longest_last = sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]]))
    for what, h, p in longest_last:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def visible(html: Column) -> Column:
    """Lower-case text of a page without tags, scripts and styles, in time that is linear in the page."""
    parts = F.split(F.lower(F.coalesce(html, F.lit(""))), r"<(?=(?:script|style)\b)")

    def shown(x: Column, k: Column) -> Column:
        end = F.when(x.startswith("script"), F.instr(x, "</script")).otherwise(F.instr(x, "</style"))
        after = F.when(end > 0, F.substring(x, end, F.length(x))).otherwise("")
        return F.when(k == 0, x).otherwise(after)

    return F.regexp_replace(F.array_join(F.transform(parts, shown), " "), r"<[^<>]*>?", " ")


@dataclass(frozen=True)
class Lexicon:
    """counts: (w, n) of every word of the visible texts; total: their sum; mean: that of one word."""

    counts: DataFrame
    total: int
    mean: int


def lexicon(pages: DataFrame) -> Lexicon:
    """Counts of all words of two and more letters a-z in the pages' visible text, with partial counts before the shuffle."""
    words = pages.select(F.explode(F.split(visible(F.col("html")), "[^a-z]+")).alias("w")).where("length(w) >= 2")
    counts = materialise(words.groupBy("w").agg(F.count("*").alias("n")), "lexicon")
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    return Lexicon(counts, int(whole["n"] or 0), max(1, int(whole["n"] or 0) // max(1, whole["v"])))


def best_split(run: str, found: list[tuple[int, str, int]], total: int, mean: int) -> list[str]:
    """The likeliest sequence of words that a run is, from the known words (place, word, count) in it.

    A known word costs the logarithm of its share, an unknown one of any length
    that of one occurrence and LETTER for each letter.
    """
    log_total = float(np.log(total + 1))
    known: list[list[tuple[int, float]]] = [[] for _ in range(len(run) + 1)]
    for i, w, n in found:
        known[i + len(w)].append((i, float(np.log(max(n, mean) if w in SEEDS else n)) - log_total))
    for w in SEEDS.difference(w for _, w, _ in found):
        i = run.find(w)
        while i >= 0:
            known[i + len(w)].append((i, float(np.log(mean)) - log_total))
            i = run.find(w, i + 1)
    best, cut, start = [0.0], [0], (0.0, 0)  # start: where an unknown word that goes on best began
    for j in range(1, len(run) + 1):
        score, i = max([(start[0] - log_total - LETTER * j, start[1]), *((best[i] + x, i) for i, x in known[j])])
        best.append(score)
        cut.append(i)
        start = max(start, (score + LETTER * j, j))
    out, j = [], len(run)
    while j:
        out.append(run[cut[j] : j])
        j = cut[j]
    return out[::-1]


def segmented(runs: DataFrame, lex: Lexicon) -> DataFrame:
    """run and words of distinct runs of letters."""
    longest = runs.agg(F.max(F.length("run"))).first()[0] or 0
    sizes = [r["k"] for r in lex.counts.select(F.length("w").alias("k")).where(F.col("k") <= longest).distinct().collect()]
    of_size = lambda k: F.transform(
        F.sequence(F.lit(1), F.length("run") - k + 1), lambda i: F.struct((i - 1).alias("i"), F.substring(F.col("run"), i, k).alias("w"))
    )
    fitting = F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda k: k <= F.length("run"))
    parts = runs.select("run", F.explode(F.flatten(F.transform(fitting, of_size))).alias("s")).select("run", "s.i", "s.w")
    found = parts.join(lex.counts, "w").groupBy("run").agg(F.collect_list(F.struct("i", "w", "n")).alias("found"))

    def each(batches: Iterator[pa.RecordBatch], total: int = lex.total, mean: int = lex.mean) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("run").to_pylist(), batch.column("found").to_pylist(), strict=True)
            words = [best_split(run, [(x["i"], x["w"], x["n"]) for x in known or ()], total, mean) for run, known in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string()))], ["run", "words"])

    return materialise(runs.join(found, "run", "left").select("run", "found").mapInArrow(each, "run string, words array<string>"), "segmented")


def runs_of(urls: DataFrame, *more: str) -> DataFrame:
    """kind (h or p) and run (letters, or # for digits and for other characters), and ``more``, of every host and path."""

    def runs(kind: str, text: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(text, F.lit(_RUN), F.lit(0)), lambda x: F.struct(F.lit(kind).alias("kind"), F.when(x.rlike("^[a-z]"), x).otherwise("#").alias("run"))
        )

    both = F.concat(runs("h", F.col("host")), runs("p", F.lower("path")))
    return urls.select(*more, F.explode(both).alias("t")).select(*more, "t.kind", "t.run")


def tokens_of(runs: DataFrame, lex: Lexicon) -> DataFrame:
    """kind, run and token of each distinct (kind, run): its words, and for a host that has a seed word one more."""
    letters = materialise(runs.select("run").where("run != '#'").distinct())
    split = segmented(letters, lex)
    words = F.coalesce("words", F.array(F.lit("#")))
    seed = F.when((F.col("kind") == "h") & F.arrays_overlap(words, F.array(*map(F.lit, sorted(SEEDS)))), F.array(F.lit("*"))).otherwise(F.array().cast("array<string>"))
    return runs.join(split, "run", "left").select("kind", "run", F.explode(F.concat(words, seed)).alias("token"))


@dataclass(frozen=True)
class UrlModel:
    """lexicon of the Viterbi; prior: log-odds of block; weights: (kind, token, weight), the tokens' log-odds."""

    lexicon: Lexicon
    prior: float
    weights: DataFrame


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and its verdict."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return urls.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def fit(pages: DataFrame, rules=RULES) -> UrlModel:
    """Lexicon from all pages and naive Bayes, with one added to each count, from all URLs that a rule judges.

    The driver gets four sums. Without URLs of either verdict the prior is even
    and no token has a weight.
    """
    lex = lexicon(pages)
    judged = parsed(pages, rules).where("verdict IS NOT NULL")
    sizes = {r["verdict"]: r["n"] for r in judged.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    of = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, 1).otherwise(0))
    seen = materialise(runs_of(judged, "verdict").groupBy("kind", "run").agg(of("block").alias("bad"), of("allow").alias("good")))
    tokens = tokens_of(seen.select("kind", "run"), lex).join(seen, ["kind", "run"])
    counts = materialise(tokens.groupBy("kind", "token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    total = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("v")).first()
    share = lambda c: F.log((F.col(c) + 1) / float((total[c] or 0) + total["v"] or 1))
    weights = materialise(counts.select("kind", "token", (share("bad") - share("good")).alias("weight")), "url-weights")
    return UrlModel(lex, float(np.log(sizes.get("block", 0) + 1) - np.log(sizes.get("allow", 0) + 1)), weights)


def scored(urls: DataFrame, model: UrlModel) -> DataFrame:
    """host, path and score, the log-odds of block, of each distinct (host, path)."""
    distinct = materialise(urls.select("host", "path").distinct())
    runs = materialise(runs_of(distinct).distinct())
    weights = tokens_of(runs, model.lexicon).join(model.weights, ["kind", "token"]).groupBy("kind", "run").agg(F.sum("weight").alias("weight"))
    sums = runs_of(distinct, "host", "path").join(materialise(weights), ["kind", "run"]).groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    return materialise(distinct.join(sums, ["host", "path"], "left").select("host", "path", (F.coalesce("weight", F.lit(0.0)) + model.prior).alias("score")))


def judge(pages: DataFrame, model: UrlModel, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score, a row for each row.

    ``score`` is the log-odds of block by naive Bayes, ``verdict`` the rule's
    or else block where the score is positive. A null URL, or one without
    ://, has empty host and path and is scored by the prior. Tokens that
    training never saw weigh nothing. Repeated rows, and rows without an id,
    are judged like others; URLs and runs of letters of any length are taken
    whole; other columns aren't read, so their names don't matter; an empty
    table gives an empty result.
    """
    urls = parsed(pages, rules)
    verdict = F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict")
    return urls.join(scored(urls, model), ["host", "path"]).select("page_id", "host", "path", "rule", verdict, "score")
