"""Class-based n-gram language model after Brown: exchange clustering, class bigrams, word emissions.

Texts are cut into blocks of bounded size. A block's words are numbered once,
in the order of their *buckets* (by a hash of the word), so what is shuffled is
a packed row for each bucket of a block, not one for each token or word. All
rows of a bucket meet in one place, where its share of the vocabulary is put
together; what is found goes back to the blocks, whatever the vocabulary's size.

Exchange clustering starts on *units*: the commonest words, each its own unit,
and tail units by a hash of a word's last letters, which hold all other words.
Unit bigrams are counted over the whole training corpus; their table has a
fixed size, so this runs on the driver. Then every other training word leaves
its tail unit, by itself, for the class that the exchange would move it to by
the classes of all its neighbours, which its bucket has counted; class bigrams
are counted anew. Only a word that training never saw has its tail unit's class. P(text) is
the product over tokens of P(class | class before) and P(word | class).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import crc_fold, drop_tables, lower_bytes, materialise, slices, spread, sums, words_of

#: Characters of text in a block, unless one text is longer.
BLOCK = 6_000_000
#: Commonest words that are units of their own, at most; tail units; classes; passes of the exchange.
HEADS, TAILS, CLASSES, PASSES = 600, 200, 48, 8
#: The end of a text, a token that no text holds.
END = " "


def tail_unit(word: str) -> int:
    """The tail unit of a word: crc32 of its last two characters."""
    return HEADS + 1 + zlib.crc32(word[-2:].encode("utf-8", "replace")) % TAILS


def pack(*columns: np.ndarray | bytes) -> bytes:
    """Columns, bytes of equal rank together, compressed; :func:`unpack` needs their types."""
    raw = [c if isinstance(c, bytes) else np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return zstandard.compress(np.array([len(x) for x in raw], "<u8").tobytes() + b"".join(raw), 3)


def unpack(packed: bytes, *kinds: str) -> list:
    """The columns that :func:`pack` was given; of kind "" is one that was bytes."""
    raw = zstandard.decompress(packed)
    out, at = [], 8 * len(kinds)
    for kind, size in zip(kinds, np.frombuffer(raw, "<u8", len(kinds)).tolist(), strict=True):
        part = raw[at : at + size]
        if kind:
            width = np.dtype(kind).itemsize
            part = np.ascontiguousarray(np.frombuffer(part, np.uint8).reshape(width, -1).T).view(kind).ravel()
        out.append(part)
        at += size
    return out


def bucket_numbers(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def blocks(docs: DataFrame, buckets: int, limit: int = BLOCK) -> DataFrame:
    """A row for each block: its words by bucket, their training counts, and its documents as word numbers.

    Null texts are empty. Column ``held_out`` must be there.
    """

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", limit):
                offsets, ids, distinct = words_of(batch.column("text"))
                number_of: dict[bytes, int] = {}
                to = np.fromiter((number_of.setdefault(w, len(number_of)) for w in lower_bytes([*distinct.to_pylist(), END])), np.int64, len(distinct) + 1)
                words = pa.array(list(number_of), pa.binary())
                order = pc.sort_indices(words).to_numpy()
                order = order[np.argsort(bucket_numbers(list(number_of), buckets)[order], kind="stable")]
                place_of = np.empty(len(order), np.int64)
                place_of[order] = np.arange(len(order))
                to = place_of[to]
                n = batch.num_rows
                tokens = np.empty(len(ids) + n, np.int64)
                ends = offsets[1:] + np.arange(n)
                inner = np.ones(len(tokens), bool)
                inner[ends] = False
                tokens[inner], tokens[ends] = to[:-1][ids], to[-1]
                held = batch.column("held_out")
                sizes = np.diff(offsets) + 1
                train = np.bincount(tokens[np.repeat(~held.to_numpy(zero_copy_only=False), sizes)], minlength=len(number_of))
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        one(words.take(pa.array(order)).cast(pa.string())),
                        one(pa.array(train, pa.int64())),
                        one(batch.column("doc_id")),
                        one(held),
                        one(pa.array(sizes, pa.int64())),
                        pa.array([pack(tokens.astype("<u4"))], pa.binary()),
                    ],
                    ["block", "words", "train", "doc_ids", "held", "sizes", "tokens"],
                )
                number += 1

    schema = "block long, words array<string>, train array<long>, doc_ids array<long>, held array<boolean>, sizes array<long>, tokens binary"
    return spread(docs.select("doc_id", "text", "held_out")).mapInArrow(cut_up, schema)


def _arrays(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of blocks with lists as arrays; ids stay Arrow's, as they may be null."""
    for k in range(batch.num_rows):
        out = {n: batch.column(n)[k] for n in batch.schema.names}
        for n, v in out.items():
            if n == "tokens":
                out[n] = unpack(v.as_py(), "<u4")[0].astype(np.int64)
            elif n == "doc_ids":
                out[n] = v.values
            else:
                out[n] = v.values.to_numpy(zero_copy_only=False) if isinstance(v, pa.ListScalar) else v.as_py()
        yield out


def unit_numbers(words: np.ndarray, heads: dict[str, int]) -> np.ndarray:
    return np.fromiter((heads.get(w) or tail_unit(w) for w in words.tolist()), np.int64, len(words))


def exchange(pairs: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Classes of units by the exchange algorithm: each unit in turn moves to where the class bigrams' likelihood is highest.

    ``pairs[a, b]``: how often b follows a. Starts from units by frequency,
    dealt round; ends when no unit moves, or after ``passes``.
    """
    n = len(pairs)
    total = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-total, kind="stable")
    of = np.empty(n, np.int64)
    of[order] = np.arange(n) % classes
    into = np.zeros((n, classes))  # pairs from a unit to a class
    outof = np.zeros((classes, n))
    for c in range(classes):
        into[:, c] = pairs[:, of == c].sum(axis=1)
        outof[c] = pairs[of == c].sum(axis=0)
    grid = np.stack([into[of == c].sum(axis=0) for c in range(classes)])
    for _ in range(passes):
        moved = 0
        for u in order.tolist():
            if not total[u]:
                continue
            own, right, left, loop = of[u], into[u].copy(), outof[:, u].copy(), pairs[u, u]
            right[own] -= loop
            left[own] -= loop
            grid[own] -= right
            grid[:, own] -= left
            grid[own, own] -= loop
            row, col = grid.sum(axis=1), grid.sum(axis=0)
            # Gain of the terms that change when u joins class c.
            gain = xlogx(grid + right).sum(axis=1) - xlogx(grid).sum(axis=1)
            gain += xlogx(grid + left[:, None]).sum(axis=0) - xlogx(grid).sum(axis=0)
            d = np.diag(grid)
            gain += xlogx(d + right + left + loop) - xlogx(d + right) - xlogx(d + left) + xlogx(d)
            gain -= xlogx(row + right.sum() + loop) - xlogx(row) + xlogx(col + left.sum() + loop) - xlogx(col)
            # The move of u's neighbours' rows and columns is the same for every c.
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            grid[best] += right
            grid[:, best] += left
            grid[best, best] += loop
            if best != own:
                of[u] = best
                into[:, own] -= pairs[:, u]
                into[:, best] += pairs[:, u]
                outof[own] -= pairs[u]
                outof[best] += pairs[u]
                moved += 1
        if not moved:
            break
    return of


#: A word's neighbours by class: those before, those after, itself after itself.
SLOTS = 2 * CLASSES + 1
#: Neighbour counts that a bucket holds before equal ones are added up; those in one computation.
HELD, ENTRIES = 2_000_000, 20_000
#: Buckets to a shuffle partition.
BUCKETS = 4


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def place(grid: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray, loop: np.ndarray) -> np.ndarray:
    """Best class of each of some words, each moved alone: the step of :func:`exchange`, for many words at once.

    ``grid``: class bigrams, the words in their ``own`` classes; ``before`` and
    ``after`` (word, class): the words' neighbours, without ``loop``, how often
    each word follows itself. A word stays if no class is better.
    """
    words, classes = before.shape
    every = np.arange(words)

    def side(table: np.ndarray, joins: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Gain from the pairs (class, k), without the word's own pairs."""
        w, k = np.nonzero(joins)
        x, home = joins[w, k], own[w]
        base = table[:, k].T.copy()
        at = np.flatnonzero(k == home)
        base[at] -= other[w[at]]  # pairs of a class with the word's own class
        base[np.arange(len(w)), home] -= x
        base[at, home[at]] -= loop[w[at]]
        gain = xlogx(base + x[:, None]) - xlogx(base)
        out = np.zeros((words, classes))
        if len(w):
            first = np.flatnonzero(np.diff(w, prepend=-1))
            out[w[first]] = np.add.reduceat(gain, first, axis=0)
        return out

    gain = side(grid, after, before) + side(grid.T, before, after)
    d = np.tile(np.diag(grid), (words, 1))
    d[every, own] -= before[every, own] + after[every, own] + loop
    gain += xlogx(d + after + before + loop[:, None]) - xlogx(d + after) - xlogx(d + before) + xlogx(d)
    ends, starts = after.sum(axis=1) + loop, before.sum(axis=1) + loop
    # Pairs from a class to the word are in that class's row wherever the word is, and so with columns.
    row, col = np.tile(grid.sum(axis=1), (words, 1)), np.tile(grid.sum(axis=0), (words, 1))
    row[every, own] -= ends
    col[every, own] -= starts
    gain -= xlogx(row + ends[:, None]) - xlogx(row) + xlogx(col + starts[:, None]) - xlogx(col)
    best = gain.argmax(axis=1)
    return np.where(gain[every, best] > gain[every, own] + 1e-9, best, own)


@dataclass(frozen=True)
class Units:
    """heads: units of the commonest words, with their counts; unit_class; grid: bigrams of the units' classes; tokens and types of training."""

    heads: dict[str, int]
    head_count: np.ndarray
    unit_class: np.ndarray
    grid: np.ndarray
    tokens: int
    types: int

    def classes(self, words: np.ndarray) -> np.ndarray:
        return self.unit_class[unit_numbers(words, self.heads)]


def commonest(counts: DataFrame, size: int = HEADS) -> list[tuple[str, int]]:
    """(word, n) of the commonest words, at most ``size``, by count and word.

    Counts fall into classes a sixteenth of a power of two wide; all words of
    the highest classes that together have at most ``size`` are taken. So the
    driver gets a row for each class and then those words, never a list from
    every task.
    """
    classed_ = counts.withColumn("class", F.floor(F.log2("n") * 16).cast("int"))
    left, least = size, None
    for r in sorted(classed_.groupBy("class").agg(F.count("*").alias("n")).collect(), reverse=True):
        left -= r["n"]
        if left < 0:
            break
        least = r["class"]
    found = [] if least is None else classed_.where(F.col("class") >= least).select("word", "n").collect()
    return sorted(((r["word"], r["n"]) for r in found), key=lambda x: (-x[1], x[0]))


def fit(table: DataFrame, counts: DataFrame) -> Units:
    """Classes of units from :func:`blocks` and its word counts (word, n), all training tokens of all blocks.

    The driver gets HEADS words and at most (HEADS + TAILS + 2)**2 unit bigrams.
    """
    top = commonest(counts)
    heads = {word: k for k, (word, _) in enumerate(top, 1)}
    units = HEADS + TAILS + 1
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(units * units, np.int64)
        for batch in batches:
            for b in _arrays(batch):
                unit = unit_numbers(b["words"], heads)[b["tokens"]]
                total += bigrams(unit, b["sizes"], b["held"], units)
        yield numbered(total)

    pairs = np.zeros(units * units)
    add_up(table.select("words", "held", "sizes", "tokens").mapInArrow(pairs_of, "at long, n long"), pairs)
    pairs = pairs.reshape(units, units)
    of = np.zeros(units, np.int64)
    of[1:] = 1 + exchange(pairs[1:, 1:])  # the start is a class of its own
    member = np.eye(CLASSES + 1)[of]
    count = np.array([0, *(n for _, n in top)], np.int64)
    return Units(heads, count, of, member.T @ pairs @ member, int(whole["n"] or 0), int(whole["v"] or 0))


def bigrams(numbers: np.ndarray, sizes: np.ndarray, held: np.ndarray, kinds: int) -> np.ndarray:
    """How often a number follows another in a block's training texts, flat; the start of a text is number 0."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[np.cumsum(sizes) - sizes] = 0
    taught = np.repeat(~held.astype(bool), sizes)
    return np.bincount(before[taught] * kinds + numbers[taught], minlength=kinds * kinds)


def numbered(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])


def add_up(partial: DataFrame, total: np.ndarray) -> None:
    for batch in partial.groupBy("at").agg(F.sum("n").alias("n")).toArrow().to_batches():
        total[batch.column("at").to_numpy()] = batch.column("n").to_numpy()


#: Packed words of a bucket: the words, training counts, numbers of entries, then the entries' slots and counts.
_NEAR = ("", "<u4", "u1", "u1", "<u4")
#: What goes back: training counts and classes.
_KNOWN = ("<u8", "u1")


def neighbours(table: DataFrame, units: Units, buckets: int) -> DataFrame:
    """bucket, block, start (number of the first word) and near, packed words with their neighbours by class; heads have none."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _arrays(batch):
                words, tokens, sizes = b["words"].tolist(), b["tokens"], b["sizes"]
                head = np.fromiter((w in units.heads for w in words), bool, len(words))
                cls = units.classes(b["words"]) - 1
                inner = np.repeat(~b["held"].astype(bool), sizes)
                inner[np.cumsum(sizes) - sizes] = False
                now = np.flatnonzero(inner)
                left, right = tokens[now - 1], tokens[now]
                same = left == right
                keys = np.concatenate((right[~same] * SLOTS + cls[left[~same]], left[~same] * SLOTS + CLASSES + cls[right[~same]], right[same] * SLOTS + 2 * CLASSES))
                keys, n = np.unique(keys[~head[keys // SLOTS]], return_counts=True)
                word, slot = np.divmod(keys, SLOTS)
                ends = np.searchsorted(word, np.arange(len(words) + 1))
                many = np.diff(ends)
                raw = [w.encode() for w in words]
                of = bucket_numbers(raw, buckets)
                cuts = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(words))
                near = [
                    pack(b"\n".join(raw[i:j]), b["train"][i:j].astype("<u4"), many[i:j].astype("u1"), slot[ends[i] : ends[j]].astype("u1"), n[ends[i] : ends[j]].astype("<u4"))
                    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[cuts[:-1]]), pa.array(np.full(len(near), b["block"])), pa.array(cuts[:-1].astype(np.int32)), pa.array(near, pa.binary())],
                    ["bucket", "block", "start", "near"],
                )

    return table.select("block", "words", "train", "held", "sizes", "tokens").mapInArrow(each, "bucket long, block long, start int, near binary")


class Bucket:
    """A share of the vocabulary, put together from the rows of all blocks."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.rows: list[tuple[int, int, np.ndarray]] = []
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, block: int, start: int, near: bytes) -> None:
        words, n, many, slot, times = unpack(near, *_NEAR)
        number = self.number
        own = np.fromiter((number.setdefault(w, len(number)) for w in words.split(b"\n")), np.int32, len(n))
        self.rows.append((block, start, own))
        self.counts.append((own, n))
        self.keys.append((np.repeat(own.astype(np.int64), many) * SLOTS + slot, times.astype(np.int64)))
        self.size += len(slot) + len(own)
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        """Add equal counts up, so that what is held depends on the words and not on the blocks."""
        number, n = (np.concatenate(x) for x in zip(*self.counts, strict=True))
        key, times = (np.concatenate(x) for x in zip(*self.keys, strict=True))
        total = np.zeros(len(self.number), np.int64)
        np.add.at(total, number, n.astype(np.int64))
        self.counts = [(np.arange(len(total), dtype=np.int32), total)]
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.keys = [(key[first], np.add.reduceat(times, first) if len(first) else times)]
        self.size = 0

    def decide(self, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training count and class of each word, and how many training types beside the heads each class has."""
        self.merge()
        (_, total), (key, times) = self.counts[0], self.keys[0]
        words = [w.decode() for w in self.number]
        unit = unit_numbers(np.array(words, object), units.heads)
        head = unit <= HEADS
        own = units.unit_class[unit] - 1
        best = own.copy()
        bounds = np.searchsorted(key, np.arange(len(words) + 1) * SLOTS)
        low = 0
        while low < len(words):
            high = min(max(low + 1, int(np.searchsorted(bounds, bounds[low] + ENTRIES, side="right")) - 1), low + ENTRIES // 4, len(words))
            part = slice(bounds[low], bounds[high])
            dense = np.zeros((high - low, SLOTS))
            dense[key[part] // SLOTS - low, key[part] % SLOTS] = times[part]
            best[low:high] = place(units.grid[1:, 1:], own[low:high], dense[:, :CLASSES], dense[:, CLASSES:-1], dense[:, -1])
            low = high
        learned = ~head & (total > 0)
        cls = 1 + np.where(learned, best, own)
        return total, cls.astype(np.uint8), np.bincount(cls[learned], minlength=CLASSES + 1)


def assigned(rows: DataFrame, units: Units) -> DataFrame:
    """block, start, known (packed training counts and classes of the words from ``start`` on) and kinds, from :func:`neighbours`.

    A head has its unit's class, and so has a word that training never saw. One
    row of each bucket has ``kinds``, the numbers of its training types by class.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def end() -> pa.RecordBatch:
            total, cls, kinds = bucket.decide(units)
            known = [pack(total[own].astype("<u8"), cls[own]) for _, _, own in bucket.rows]
            block, start = (np.array([x[k] for x in bucket.rows], np.int64) for k in (0, 1))
            types = [kinds.astype("<i8").tobytes(), *[None] * (len(known) - 1)]
            return pa.RecordBatch.from_arrays([pa.array(block), pa.array(start), pa.array(known, pa.binary()), pa.array(types, pa.binary())], ["block", "start", "known", "kinds"])

        before, bucket = None, Bucket()
        for batch in batches:
            for now, block, start, near in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if before not in (None, now):
                    yield end()
                    bucket = Bucket()
                bucket.add(block, start, near)
                before = now
        if before is not None:
            yield end()

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(each, "block long, start long, known binary, kinds binary")


def classed(table: DataFrame, units: Units, buckets: int) -> DataFrame:
    """The blocks with class and training count of every word, and their bigrams and types by class."""
    known = assigned(neighbours(table, units, buckets), units)
    known = known.groupBy("block").agg(F.collect_list(F.struct("start", "known", "kinds")).alias("parts"))
    side = CLASSES + 1

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, pairs = [], []
            for k, b in enumerate(_arrays(batch.drop_columns(["parts"]))):
                kinds = np.zeros(side, np.int64)
                total, cls = [], []
                for part in sorted(batch.column("parts")[k].as_py(), key=lambda x: x["start"]):
                    n, c = unpack(part["known"], *_KNOWN)
                    total.append(n)
                    cls.append(c)
                    if part["kinds"] is not None:
                        kinds += np.frombuffer(part["kinds"], "<i8")
                cls = np.concatenate(cls)
                words.append(pack(np.concatenate(total), cls))
                pairs.append(pack(np.append(bigrams(cls.astype(np.int64)[b["tokens"]], b["sizes"], b["held"], side), kinds).astype("<i8")))
            columns = {c: batch.column(c) for c in ("doc_ids", "held", "sizes", "tokens")}
            yield pa.RecordBatch.from_pydict(columns | {"words": pa.array(words, pa.binary()), "pairs": pa.array(pairs, pa.binary())})

    rest = "doc_ids array<long>, held array<boolean>, sizes array<long>, tokens binary"
    begun = table.select("block", "doc_ids", "held", "sizes", "tokens")
    return begun.join(known, "block").drop("block").mapInArrow(finish, f"{rest}, words binary, pairs binary")


@dataclass(frozen=True)
class ClassModel:
    """moves: log10 P(class | class before); mass: log10 of each class's token and type count; tokens and types of training."""

    moves: np.ndarray
    mass: np.ndarray
    tokens: int
    types: int


def model_of(done: DataFrame, units: Units) -> ClassModel:
    """The model from :func:`classed`; the driver gets at most (CLASSES + 2) * (CLASSES + 1) counts."""
    side = CLASSES + 1

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * (side + 1), np.int64)
        for batch in batches:
            for packed in batch.column("pairs").to_pylist():
                total += unpack(packed, "<i8")[0]
        yield numbered(total)

    total = np.zeros(side * (side + 1))
    add_up(done.select("pairs").mapInArrow(sum_up, "at long, n long"), total)
    grid = total[: side * side].reshape(side, side)
    types = total[side * side :] + np.bincount(units.unit_class[1 : len(units.heads) + 1], minlength=side)
    follows = grid.sum(axis=0) + 0.1
    follows[0] = 0
    follows /= follows.sum()
    seen = grid.sum(axis=1, keepdims=True)
    kinds = (grid > 0).sum(axis=1, keepdims=True) + 1
    moves = (grid + kinds * follows) / (seen + kinds)  # Witten-Bell over the class unigrams
    mass = np.log10(grid.sum(axis=0) + types + 1)
    with np.errstate(divide="ignore"):
        return ClassModel(np.log10(moves), mass, units.tokens, units.types)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, a row for each row.

    Rows whose crc32(doc_id as text) mod 7 is 2 are held out from all that is
    learned; a null doc_id is not. Null and empty texts are the end token
    alone. Repeated rows are learned from and scored each. Ids of any size, and
    null ones, come back as they are. Other columns of ``docs`` aren't read,
    whatever their names; an empty table gives an empty result. ``score`` is
    the log10 probability by the class model, in which a word with no count has
    the share of one more word of its class; ``base_score`` that by add-one
    unigrams.
    """
    marked = docs.select("doc_id", "text", F.coalesce(crc_fold(F.col("doc_id"), 7, 2), F.lit(False)).alias("held_out"))
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = materialise(blocks(marked, buckets), "blocks")
    rows = table.select(F.explode(F.arrays_zip("words", "train")).alias("w")).select(F.col("w.words").alias("word"), F.col("w.train").alias("n"))
    counts = materialise(rows.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    units = fit(table, counts)
    done = materialise(classed(table, units, buckets), "classed")
    drop_tables(docs.sparkSession, table, counts)
    model = model_of(done, units)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _arrays(batch):
                count, word_class = unpack(b["words"], *_KNOWN)
                count, word_class = count.astype(float), word_class.astype(np.int64)
                tokens, sizes = b["tokens"], b["sizes"]
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                emission = np.log10(count + 1) - model.mass[word_class]
                classes = word_class[tokens]
                before = np.empty_like(classes)
                before[1:] = classes[:-1]
                before[offsets[:-1]] = 0
                by_class = model.moves[before, classes] + emission[tokens]
                base = np.log10(count + 1) - np.log10(model.tokens + model.types + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        b["doc_ids"],
                        pa.array(b["held"].astype(bool)),
                        pa.array(sizes),
                        pa.array(sums((count[tokens] > 0).astype(np.int64), offsets)),
                        pa.array(np.full(len(sizes), model.tokens)),
                        pa.array(sums(base[tokens], offsets)),
                        pa.array(sums(by_class, offsets)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return done.drop("pairs").mapInArrow(each, schema)
