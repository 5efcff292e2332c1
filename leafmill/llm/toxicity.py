"""Toxic spans by a linear-chain conditional random field.

Document labels give features (words and their first letters) that come with
toxic documents; tokens with such a feature in a toxic document are the
labelled tokens that the field is trained on. Scoring runs forward-backward
over every token. A token without any learned feature has the same factor
wherever it stands, so a stretch of such tokens is a power of one matrix,
taken by its eigenvalues: the marginals are exact and cost as much as there are
tokens with features. Token marginals aggregate to a document's score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import crc_fold, materialise, slices, spread, words_of

#: Labelled documents of each kind that are expected to be learned from.
SAMPLE = 3000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_NO_TOKEN = (-6.0, -6.0)


def token_features(word: str) -> tuple[str, ...]:
    """A word's features: itself without outer punctuation, in lower case, and its first four and five letters, if it has them."""
    w = word.strip(_TRIM).lower()
    if not w:
        return ()
    return (f"w:{w}", *(f"{k}:{w[:k]}" for k in (4, 5) if len(w) >= k))


@dataclass(frozen=True)
class ToxicModel:
    """features: their weights for the toxic state; bias and moves (2 by 2) of the chain; calibration of the score."""

    features: dict[str, float]
    bias: float
    moves: np.ndarray
    calibration: tuple[float, float, float]


class Chain:
    """Forward-backward over tokens with emissions, neutral stretches in between."""

    def __init__(self, bias: float, moves: np.ndarray):
        self.bias, self.step = bias, np.exp(moves)
        neutral = self.step * np.exp([0.0, bias])
        values, vectors = np.linalg.eig(neutral)
        order = np.argsort(-np.abs(values))
        values, self.vectors = values[order].real, vectors[:, order].real
        self.ratio, self.inverse = values[1] / values[0], np.linalg.inv(self.vectors)

    def gap(self, tokens: int) -> np.ndarray:
        """The factor of so many neutral tokens, up to a scale."""
        return self.vectors @ np.diag([1.0, self.ratio**tokens]) @ self.inverse

    def marginals(self, at: list[int], emission: list[float], length: int) -> list[float]:
        """Probability of the toxic state of the tokens ``at``, of ``length`` tokens in all."""
        n = len(at)
        forward, steps = [], []
        state, before = None, -1
        for k in range(n):
            gap, e = at[k] - before - 1, np.exp([0.0, self.bias + emission[k]])
            if state is None:
                state = np.array([1.0, np.exp(self.bias)]) @ self.gap(gap - 1) if gap else None
                step = None
                state = e if state is None else state @ self.step * e
            else:
                step = (self.gap(gap) if gap else np.eye(2)) @ self.step * e
                state = state @ step
            state = state / state.sum()
            forward.append(state)
            steps.append(step)
            before = at[k]
        back = self.gap(length - at[-1] - 1) @ np.ones(2) if length > at[-1] + 1 else np.ones(2)
        out = [0.0] * n
        for k in range(n - 1, -1, -1):
            both = forward[k] * back
            out[k] = float(both[1] / both.sum())
            if k:
                back = steps[k] @ back
                back = back / back.sum()
        return out


def summary(marginals: list[float]) -> tuple[float, float]:
    """Log of the expected number of toxic tokens, and log-odds of the likeliest, within bounds."""
    if not marginals:
        return _NO_TOKEN
    top = min(max(max(marginals), 1e-6), 1 - 1e-6)
    return max(float(np.log(sum(marginals) + 1e-9)), -6.0), max(float(np.log(top / (1 - top))), -6.0)


def _hits(batch: pa.RecordBatch, weights: dict[str, float]) -> Iterator[tuple[int, int, list[int], list[str]]]:
    """Row, number of tokens, places and words of the tokens that have a known feature, for each text."""
    offsets, ids, distinct = words_of(batch.column("text"))
    words = distinct.to_pylist()
    hit = np.fromiter((any(f in weights for f in token_features(w)) for w in words), bool, len(words))
    places = np.flatnonzero(hit[ids]) if len(ids) else np.zeros(0, np.int64)
    bounds = np.searchsorted(places, offsets)
    for row in range(len(offsets) - 1):
        own = places[bounds[row] : bounds[row + 1]]
        yield row, int(offsets[row + 1] - offsets[row]), (own - offsets[row]).tolist(), [words[i] for i in ids[own].tolist()]


def _learned_from(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of about SAMPLE labelled documents of either kind, by a hash of their ids; never held-out ones."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~crc_fold(F.col("doc_id"), 4, 2)).where("toxic IN (0, 1)")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, SAMPLE / max(1, sizes.get(1, 0)))).otherwise(min(1.0, SAMPLE / max(1, sizes.get(0, 0))))
    draw = F.pmod(F.xxhash64(F.lit("toxic sample"), "doc_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    chosen = materialise(known.where(draw < rate))  # about 2 * SAMPLE rows
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Train on about SAMPLE documents of either kind.

    ``labels`` has doc_id and toxic; null ones teach nothing, and of repeated
    ones the highest counts. The driver gets the sample's features that come
    with toxic documents and the sample's tokens that have one, so what it
    holds is bounded by the sample's texts. Without labels of both kinds, no
    feature is learned and all documents have one score.
    """
    sample = materialise(_learned_from(docs, labels).dropDuplicates(["text"]))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [sorted({f for w in set(_WORD.findall(t)) for f in token_features(w)}) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column("toxic")], ["f", "toxic"])

    counts = sample.mapInArrow(seen, "f array<string>, toxic int").select(F.explode("f").alias("f"), "toxic")
    counts = counts.groupBy("f").agg(F.sum("toxic").alias("bad"), F.sum(F.lit(1) - F.col("toxic")).alias("good"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad_n, good_n = sizes.get(1, 0), sizes.get(0, 0)
    lift = F.log((F.col("bad") + 0.5) / (bad_n + 1)) - F.log((F.col("good") + 0.5) / (good_n + 1))
    chosen = counts.where(F.col("bad") >= 4 + 0.002 * bad_n).withColumn("lift", lift).where("lift > 1.5")
    features = {r["f"]: r["lift"] for r in chosen.collect()} if bad_n and good_n else {}
    pure = {f for f, x in features.items() if x > 2.5}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = list(_hits(batch, features))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in rows], t) for k, t in ((1, pa.int64()), (2, pa.list_(pa.int64())), (3, pa.list_(pa.string())))] + [batch.column("toxic")],
                    ["tokens", "at", "words", "toxic"],
                )

    docs_seen = [tuple(r) for r in sample.mapInArrow(hits, "tokens long, at array<long>, words array<string>, toxic int").collect()] if features else []
    docs_seen.sort(key=repr)
    weights, bias, moves = _train(docs_seen, sorted(features), pure)
    chain, x, y = Chain(bias, moves), [], []
    for tokens, at, words, toxic in docs_seen:
        emission = [sum(weights.get(f, 0.0) for f in token_features(w)) for w in words]
        x.append((1.0, *summary(chain.marginals(at, emission, tokens) if at else [])))
        y.append(toxic)
    return ToxicModel(weights, bias, moves, _calibrate(np.array(x).reshape(-1, 3), np.array(y, float)))


def _train(seen: list, names: list[str], pure: set[str], steps: int = 150) -> tuple[dict[str, float], float, np.ndarray]:
    """Weights by gradient steps (Adam) on the likelihood of labelled stretches of tokens.

    A stretch is the featured tokens that lie at most four apart, with two
    neutral tokens on either side; a token is toxic if it has a pure feature
    and its document is labelled so.
    """
    index = {f: k for k, f in enumerate(names)}
    stretches: list[list[tuple[list[int], int]]] = []
    for _, at, words, toxic in seen:
        before = None
        for a, w in zip(at, words, strict=True):
            f = token_features(w)
            token = ([index[x] for x in f if x in index], int(bool(toxic) and any(x in pure for x in f)))
            if before is None or a - before > 4 or len(stretches[-1]) > 40:
                stretches.append([([], 0), ([], 0)])
            else:
                stretches[-1] += [([], 0)] * (a - before - 1)
            stretches[-1].append(token)
            before = a
    stretches = [s + [([], 0), ([], 0)] for s in stretches]
    k = len(names)
    theta = np.zeros(k + 5)
    theta[k] = -3.0
    if not stretches:
        return {}, -3.0, np.zeros((2, 2))
    n = len(stretches)
    groups = [_padded(own) for own in _by_width(stretches)]
    real = sum(g.moves for g in groups)
    m = v = np.zeros_like(theta)
    for step in range(1, steps + 1):
        moves = theta[k + 1 :].reshape(2, 2)
        gradient = np.zeros_like(theta)
        expected = np.zeros((2, 2))
        for g in groups:
            emission = np.bincount(g.place, theta[g.features], g.mask.size).reshape(g.mask.shape) + theta[k]
            p1, pair = _expect(emission, moves, g.mask)
            off = np.where(g.mask, g.label - p1, 0.0)
            gradient[:k] += np.bincount(g.features, off.ravel()[g.place], k)
            gradient[k] += off.sum()
            expected += pair
        gradient[k + 1 :] = (real - expected).ravel()
        gradient = gradient / n - 1e-3 * theta / np.sqrt(n)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return dict(zip(names, theta[:k].tolist(), strict=True)), float(theta[k]), theta[k + 1 :].reshape(2, 2)


@dataclass(frozen=True)
class _Padded:
    """Stretches of similar length: labels and which places are real, the places of all features, and the labels' moves."""

    label: np.ndarray
    mask: np.ndarray
    place: np.ndarray
    features: np.ndarray
    moves: np.ndarray


def _by_width(stretches: list) -> list[list]:
    """Stretches whose lengths have one next power of two, so that little is padded."""
    groups: dict[int, list] = {}
    for s in stretches:
        groups.setdefault((len(s) - 1).bit_length(), []).append(s)
    return [groups[k] for k in sorted(groups)]


def _padded(stretches: list) -> _Padded:
    n, width = len(stretches), max(map(len, stretches))
    label, mask = np.zeros((n, width), int), np.zeros((n, width), bool)
    places, features = [], []
    for i, s in enumerate(stretches):
        for j, (f, y) in enumerate(s):
            label[i, j], mask[i, j] = y, True
            places += [i * width + j] * len(f)
            features += f
    both = mask[:, 1:]
    moves = np.array([[((label[:, :-1] == a) & (label[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    return _Padded(label, mask, np.array(places, int), np.array(features, int), moves)


def _expect(emission: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 and expected moves of padded stretches, by scaled forward-backward."""
    n, width = emission.shape
    e = np.stack((np.ones_like(emission), np.exp(np.clip(emission, -30, 30))), axis=2)
    step = np.exp(moves)
    alpha, scale = np.zeros((n, width, 2)), np.ones((n, width))
    for j in range(width):
        a = e[:, 0] if j == 0 else (alpha[:, j - 1] @ step) * e[:, j]
        scale[:, j] = a.sum(axis=1)
        alpha[:, j] = a / scale[:, j : j + 1]
        if j:
            alpha[:, j] = np.where(mask[:, j : j + 1], alpha[:, j], alpha[:, j - 1])
    beta = np.ones((n, width, 2))
    for j in range(width - 2, -1, -1):
        b = (beta[:, j + 1] * e[:, j + 1]) @ step.T / scale[:, j + 1 : j + 2]
        beta[:, j] = np.where(mask[:, j + 1 : j + 2], b, 1.0)
    both = alpha * beta
    p1 = both[:, :, 1] / both.sum(axis=2)
    pair = alpha[:, :-1, :, None] * step * (e[:, 1:] * beta[:, 1:] / scale[:, 1:, None])[:, :, None, :]
    return p1, (pair * mask[:, 1:, None, None]).sum(axis=(0, 1))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the labels on a document's summary."""
    w = np.zeros(3)
    for _ in range(60 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        w = w + np.linalg.solve(hess, x.T @ (y - p) - 0.05 * w)
    return tuple(w.tolist())


def score(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and spans, a row for each row.

    ``spans`` are (start, end, probability) of the tokens whose marginal
    reaches ``threshold``, in code points. Null, empty and blank texts have the
    score of a text without any featured token and no span. Whole texts are
    read; repeated rows are treated alike, other columns aren't read, whatever
    their names, a null doc_id is not held out, and an empty table gives an
    empty result.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(model.bias, model.moves)
        for whole in batches:
            for batch in slices(whole, "text"):
                scores, spans = [], []
                texts = batch.column("text")
                for row, tokens, at, words in _hits(batch, model.features):
                    p = []
                    if at:
                        emission = [sum(model.features.get(f, 0.0) for f in token_features(w)) for w in words]
                        p = chain.marginals(at, emission, tokens)
                    z = float(np.dot(model.calibration, (1.0, *summary(p))))
                    scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                    bad = {a: x for a, x in zip(at, p, strict=True) if x >= threshold}
                    own = []
                    if bad:
                        own = [{"start": m.start(), "end": m.end(), "p": bad[k]} for k, m in enumerate(_WORD.finditer(texts[row].as_py())) if k in bad]
                    spans.append(own)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    schema = "doc_id long, score double, spans array<struct<start: long, end: long, p: double>>"
    found = spread(docs.select("doc_id", "text")).mapInArrow(each, schema)
    return found.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 4, 2), F.lit(False)).alias("held_out"), "score", "spans")
