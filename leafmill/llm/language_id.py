"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability is the sum over *all* its segmentations into pieces,
which a forward algorithm gives; a text's is the product over its words.
Piece probabilities are expected counts under forward-backward, from uniform
ones on, over a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import crc_fold, local_file, slices, spread, sums, words_of

VOCABULARY = "piece_bpe_32k.model"
#: Labelled documents a language that are expected to be learned from.
SAMPLE = 1500
ROUNDS = 2
#: Probability of a character that is no piece, alike for all languages.
UNKNOWN = 1e-7
#: Words shorter than this are handled together with others of their length, longer ones by themselves.
TOGETHER = 40
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEP = np.uint64(0x100000001B3)


class Pieces:
    """The vocabulary: pieces by string and by hash of their characters."""

    def __init__(self, path: str = VOCABULARY):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=local_file(path))
        self.size = model.get_piece_size()
        usable = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i): i for i in usable}
        self.longest = max(map(len, self.ids))
        self.unknown, self.nothing = self.size, self.size + 1
        self._tables = []
        left = [(self.hash(p), i) for p, i in self.ids.items()]
        for k in range(8):
            shift, key, value, rest = np.uint64(46), np.zeros(1 << 18, np.uint64), np.full(1 << 18, self.nothing), []
            factor = np.uint64((_MULTIPLIERS[k % 2] + 2 * k) & (2**64 - 1) | 1)
            for h, i in left:
                slot = int((h * int(factor) & (2**64 - 1)) >> 46)
                if value[slot] == self.nothing:
                    key[slot], value[slot] = h, i
                else:
                    rest.append((h, i))
            self._tables.append((factor, shift, key, value))
            left = rest
            if not left:
                break

    @staticmethod
    def hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_STEP) + ord(c) + 1) & (2**64 - 1)
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes; ``nothing`` where there is none."""
        out = np.full(len(h), self.nothing)
        for factor, shift, key, value in self._tables:
            slot = (h * factor) >> shift
            out = np.where(key[slot] == h, value[slot], out)
        return out

    def edges(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, piece numbers) of all stretches of equally long words, by start."""
        n = codes.shape[1]
        for i in range(n):
            h = np.zeros(len(codes), np.uint64)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                h = h * _STEP + codes[:, j - 1] + np.uint64(1)
                found = self.find(h)
                if j == i + 1:
                    found = np.where(found == self.nothing, self.unknown, found)
                elif (found == self.nothing).all():
                    continue
                yield i, j, found

    def word_edges(self, word: str) -> Iterator[tuple[int, int, int]]:
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                found = self.ids.get(word[i:j], self.unknown if j == i + 1 else None)
                if found is not None:
                    yield i, j, found


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def by_length(words: list[str], least: int = 32) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Word numbers of one length each and their characters; no characters for long or rare lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for at in np.split(order, cuts):
        n = int(size[at[0]]) if len(at) else 0
        if n and n < TOGETHER and len(at) >= least:
            yield at, np.array([words[k] for k in at.tolist()], dtype=f"U{n}").view(np.uint32).reshape(len(at), n).astype(np.uint64)
        elif n:
            yield at, None


def log_probabilities(words: list[str], vocabulary: Pieces, table: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability in each language, all segmentations summed.

    ``table`` has a row for every piece, one for unknown characters and one of
    zeros, a column for each language.
    """
    out = np.zeros((len(words), table.shape[1]))
    for at, codes in by_length(words):
        if codes is None:
            for k in at.tolist():
                out[k] = _forward(words[k], vocabulary, table)
            continue
        alpha = np.zeros((codes.shape[1] + 1, len(at), table.shape[1]))
        alpha[0] = 1
        for i, j, found in vocabulary.edges(codes):
            alpha[j] += alpha[i] * table[found]
        out[at] = np.log(alpha[-1])
    return out


def _ending(word: str, j: int, vocabulary: Pieces) -> Iterator[tuple[int, int]]:
    """(start, piece number) of the pieces that end at ``j``."""
    for i in range(max(0, j - vocabulary.longest), j):
        found = vocabulary.ids.get(word[i:j], vocabulary.unknown if i == j - 1 else None)
        if found is not None:
            yield i, found


def _prefixes(word: str, vocabulary: Pieces, table: np.ndarray) -> np.ndarray:
    """Natural log of the probability of every prefix of a word of any length; in logs, so nothing underflows."""
    out = np.zeros((len(word) + 1, table.shape[1]))
    for j in range(1, len(word) + 1):
        # A single character is always a piece, so no sum is of nothing; the prefix one shorter sets the scale.
        out[j] = out[j - 1] + np.log(sum(np.exp(out[i] - out[j - 1]) * table[found] for i, found in _ending(word, j, vocabulary)))
    return out


def _forward(word: str, vocabulary: Pieces, table: np.ndarray) -> np.ndarray:
    """As above for one word of any length."""
    return _prefixes(word, vocabulary, table)[-1]


def _expected_alone(word: str, weight: np.ndarray, vocabulary: Pieces, table: np.ndarray, out: np.ndarray) -> None:
    """Add one word's expected piece counts to ``out``: each end passes what it has on to its pieces' starts, by their shares."""
    log = _prefixes(word, vocabulary, table)
    through = np.zeros_like(log)
    through[-1] = weight
    for j in range(len(word), 0, -1):
        for i, found in _ending(word, j, vocabulary):
            share = through[j] * np.exp(log[i] - log[j]) * table[found]
            out[found] += share
            through[i] += share


def expected(words: list[str], weight: np.ndarray, vocabulary: Pieces, table: np.ndarray) -> np.ndarray:
    """Expected piece counts a language by forward-backward; ``weight``: how often each word occurs in each."""
    out = np.zeros_like(table)
    for at, codes in by_length(words, least=1):
        if codes is None:
            for k in at.tolist():
                _expected_alone(words[k], weight[k], vocabulary, table, out)
            continue
        edges = list(vocabulary.edges(codes))
        alpha = np.zeros((codes.shape[1] + 1, len(at), table.shape[1]))
        beta = np.zeros_like(alpha)
        alpha[0], beta[-1] = 1, 1
        for i, j, found in edges:
            alpha[j] += alpha[i] * table[found]
        for i, j, found in sorted(edges, key=lambda e: -e[0]):
            beta[i] += beta[j] * table[found]
        scale = weight[at] / alpha[-1]
        for i, j, found in edges:
            share = alpha[i] * table[found] * beta[j] * scale
            for k in range(table.shape[1]):
                out[:, k] += np.bincount(found, share[:, k], len(table))
    return out


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray
    vocabulary: str


def _sample(docs: DataFrame, languages: dict[str, int]) -> DataFrame:
    """Labelled documents by a hash of their id, about SAMPLE a language."""
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, SAMPLE / n))) for k, n in languages.items()])
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    return docs.where(draw < rate)


def fit(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> LanguageModel:
    """Learn piece probabilities of every language in ``lang``; null text or lang teaches nothing.

    Rows whose crc32(doc_id as text) mod 4 is 2, or that have no doc_id, are
    held out. The driver gets the languages and at most a row for each piece
    and language. Every word of the sample teaches, however long. An empty
    table gives a model without languages; repeated rows are learned from each.
    """
    labelled = docs.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    labelled = labelled.where(~crc_fold(F.col("doc_id"), 4, 2))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    size = pieces(vocabulary).size
    table = np.full((size + 2, len(languages)), 1.0 / size)
    table[size], table[size + 1] = UNKNOWN, 0
    if not languages:
        return LanguageModel((), table, vocabulary)
    sample = _sample(labelled, sizes)
    for _ in range(rounds):

        def count(batches: Iterator[pa.RecordBatch], table: np.ndarray = table) -> Iterator[pa.RecordBatch]:
            known, total = pieces(vocabulary), np.zeros_like(table)
            for whole in batches:
                for batch in slices(whole, "text", 2_000_000):
                    offsets, ids, distinct = words_of(batch.column("text"))
                    lang = np.array([languages.index(x) for x in batch.column("lang").to_pylist()], np.int64)
                    weight = np.zeros((len(distinct), len(languages)))
                    np.add.at(weight, (ids, np.repeat(lang, np.diff(offsets))), 1)
                    total += expected(["▁" + w for w in distinct.to_pylist()], weight, known, table)
            i, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(k), pa.array(total[i, k])], ["piece", "lang", "n"])

        counted = sample.mapInArrow(count, "piece long, lang long, n double")
        n = np.zeros_like(table)
        for r in counted.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():
            n[r["piece"], r["lang"]] = r["n"]
        n = n[:size] + 0.1
        table = np.concatenate((n / n.sum(axis=0), table[size:]))
    return LanguageModel(languages, table, vocabulary)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score, a row for each row.

    ``und`` with score 0 if a text is null or has no letter, or nothing was
    learned; else the likeliest language, of equals the first by name, and its
    posterior under equal priors. Every word of a text counts. Repeated rows
    are treated alike, other columns aren't read, whatever their names, and a null
    doc_id is not held out. An empty table gives an empty result.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model.vocabulary)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = pc.fill_null(batch.column("text"), "")
                letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
                if model.languages:
                    offsets, ids, distinct = words_of(texts)
                    word = log_probabilities(["▁" + w for w in distinct.to_pylist()], known, model.table)
                    total = sums(word[ids], offsets)
                    best = total.argmax(axis=1)
                    share = np.exp(total - total.max(axis=1, keepdims=True))
                    score = np.where(letters, share.max(axis=1) / share.sum(axis=1), 0.0)
                    name = [model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
                else:
                    name, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(name, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = spread(docs.select("doc_id", "text")).mapInArrow(each, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score")
