"""Best-fit-decreasing packing of token sequences.

Tokenising, cutting and numbering run over the documents. Packing itself needs
only how many pieces there are of each length, at most ``capacity`` numbers
whatever the corpus: best-fit decreasing takes lengths from long to short and
puts each piece into the open bin with the least room that still holds it,
which a segment tree over room sizes finds in logarithmic time. Bins of equal
history move together as one run, so the plan is small, and it is exact: the
bins are those of the one-by-one algorithm. Each piece then finds its bin from
its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import local_file, materialise, ragged, slices, spread, words_of

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"

#: Words for which the short way below is known to equal the library's: printable ASCII and Latin-1 letters.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_PRETOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_END = b"\xff"
_CACHE_WORDS = 200_000


def _byte_table() -> dict[str, int]:
    """Byte that a character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordEncoder:
    """Token ids of single words by a public word-end BPE vocabulary.

    White space separates the vocabulary's pretokens and is dropped, so a
    text's ids are its words' ids, one after the other. Plain words go through
    a byte-pair merger with the same merge order, in which the word end is a
    byte that no UTF-8 text holds; all others through the library itself.
    """

    def __init__(self, path: str = TOKENIZER):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        place = local_file(path)
        with open(place, encoding="utf-8") as f:
            model = json.load(f)["model"]
        table = _byte_table()

        def raw(token: str) -> bytes:
            core, end = (token[:-4], _END) if token.endswith("</w>") else (token, b"")
            return bytes(table[c] for c in core) + end

        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + _END: 256 + b for b in range(256)}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks.setdefault(raw(a) + raw(b), 512 + k)
        self._ids = [0] * (512 + len(model["merges"]))
        for token, i in model["vocab"].items():
            if not token.startswith("<|"):
                self._ids[ranks[raw(token)]] = i
        self._merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self._library = Tokenizer.from_file(place)
        self._cache: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        known = self._cache.get(w)
        if known is None:
            if _PLAIN.fullmatch(w) and "<|" not in w:
                ids = self._ids
                known = [ids[r] for p in _PRETOKENS.findall(w.lower()) for r in self._merge(p.encode() + _END)]
            else:
                known = self._library.encode(w, add_special_tokens=False).ids
            if len(self._cache) >= _CACHE_WORDS:
                self._cache.clear()
            if len(w) <= 64:
                self._cache[w] = known
        return known

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, id 0 after each, and how many ids each has."""
        offsets, words, distinct = words_of(texts)
        known = [self.word(w) for w in distinct.to_pylist()]
        size = np.fromiter(map(len, known), np.int64, len(known))
        flat = np.fromiter((i for ids in known for i in ids), "<u4", int(size.sum()))
        starts = np.cumsum(size) - size
        per_word = size[words]
        run = np.concatenate(([0], np.cumsum(per_word)))
        counts = run[offsets[1:]] - run[offsets[:-1]] + 1
        out = np.zeros(int(counts.sum()), "<u4")
        row = np.repeat(np.arange(len(counts)), np.diff(offsets))
        out[ragged(run[:-1] + row, per_word)] = flat[ragged(starts[words], per_word)]
        return out, counts


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, task_rank long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, each numbered within its task and length.

    ``with_ids`` adds the ids as little-endian unsigned 32-bit integers. A null
    or empty text is one piece of the id 0; rows without a doc_id, and repeated
    ones, have their own pieces; other columns aren't read.
    """

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, enc = TaskContext.get().partitionId(), defaultdict(int), encoder(tokenizer)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, counts = enc.texts(batch.column("text"))
                per_doc = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), per_doc)
                piece = ragged(np.zeros(len(counts), np.int64), per_doc)
                start = piece * capacity
                length = np.minimum(counts[row] - start, capacity)
                begin = (np.cumsum(counts) - counts)[row] + start
                raw = ids.tobytes()
                parts = [raw[4 * a : 4 * b] for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                rank = np.empty(len(length), np.int64)
                for k, n in enumerate(length.tolist()):
                    rank[k] = seen[n]
                    seen[n] += 1
                columns = [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    pa.array(np.full(len(length), task, np.int32)),
                    pa.array(rank),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"]
                if with_ids:
                    columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return spread(docs.select("doc_id", "text")).mapInArrow(cut_up, PIECES + ", ids binary" * with_ids)


class RoomTree:
    """Segment tree over room sizes 0 to ``top``: which have open bins, and the least that is large enough."""

    def __init__(self, top: int):
        self.size = 1 << (top + 1 - 1).bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, room: int, there: bool) -> None:
        k = room + self.size
        self.any[k] = there
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that has an open bin."""
        k = least + self.size
        if self.any[k]:
            return least
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` pieces of each length.

    Returns runs (length, first rank, pieces, first bin, pieces a bin, offset):
    the pieces of that length with ranks from ``first rank`` on fill bins from
    ``first bin`` on, so many in each, from ``offset`` in the bin.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: runs (first bin, bins), the last first
    tree, runs, bins = RoomTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, fits = capacity, capacity // length
                first, number = bins, -(-left // fits)
                bins += number
            else:
                first, number = rooms[room].pop()
                fits = room // length
                if not rooms[room]:
                    tree.set(room, False)
            full = min(number, left // fits)
            odd = min(left - full * fits, fits) if full < number else 0
            if full:
                runs.append((length, rank, full * fits, first, fits, capacity - room))
                _open(rooms, tree, room - fits * length, first, full)
            if odd:
                runs.append((length, rank + full * fits, odd, first + full, odd, capacity - room))
                _open(rooms, tree, room - odd * length, first + full, 1)
            rest = number - full - bool(odd)
            if rest:
                _open(rooms, tree, room, first + full + bool(odd), rest)
            rank += full * fits + odd
            left -= full * fits + odd
    return runs


def _open(rooms: dict[int, list[tuple[int, int]]], tree: RoomTree, room: int, first: int, number: int) -> None:
    if room:
        rooms[room].append((first, number))
        tree.set(room, True)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).
    Null and empty texts have the single id 0. A text longer than ``capacity``
    is cut into full pieces and a rest. Rows that repeat a doc_id, or have none,
    are packed each; equal lengths are numbered in any order. Other columns
    aren't read, whatever their names; an empty table gives an empty result. Pieces are written to the shared
    folder once, since their ranks must not change; the driver gets one count a
    length, at most ``capacity`` numbers.
    """
    table = materialise(pieces(docs, capacity, tokenizer, with_ids), "pieces")
    per_task = table.groupBy("task", "length").agg(F.count("*").alias("n"))
    order = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = sorted(plan(counts, capacity))
    run_length, run_rank, _, run_bin, run_fits, run_offset = (np.array(x, np.int64) for x in zip(*(runs or [(0, 0, 1, 0, 1, 0)]), strict=True))
    step = max(counts.values(), default=0) + 1
    run_key = run_length * step + run_rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(run_key, length * step + rank, side="right") - 1
            nth = rank - run_rank[k]
            sequence = run_bin[k] + nth // run_fits[k]
            offset = run_offset[k] + nth % run_fits[k] * length
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            columns |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_pydict(columns)

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = table.join(before, ["task", "length"]).select(*kept, (F.col("before") + F.col("task_rank")).alias("rank"))
    types = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return ranked.mapInArrow(place, types + ", sequence_id long, offset long")
