"""SentencePiece encoding with seeded merge-dropout, and decoding.

Pieces are merged from characters by an agenda: the candidate merge with the
best score first, of equals the leftmost. With dropout, a candidate that comes
up is skipped if a hash of (document, place in its text, piece), keyed by the
seed, falls below the rate; so each occurrence of a word has a segmentation of
its own, one seed gives the same ones wherever and however often a task runs,
and another seed gives others. No piece reaches over a space into what follows
a letter, so a text is cut into stretches (spaces and the word after them).
Stretches of equal length are merged together, a step of all agendas at a time:
a candidate's draw depends on nothing that happens before it comes up, so those
to be skipped are left out at once. Long stretches keep an agenda of their own.

Decoding gives the text back exactly: characters outside the vocabulary, and
the space mark where a text holds it itself, are written as bytes.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .shared import local_file, slices, spread

VOCABULARY = "piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 20_240_613
MARK = "\u2581"
_MASK = (1 << 64) - 1
#: Longest stretch that is merged together with others; stretches in one step; characters of texts encoded together, unless one is longer.
TOGETHER, WIDE, CHARS = 48, 8_192, 1_000_000
_NONE = np.int64(1 << 40)
_PLACE, _PIECE, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class PieceCodec:
    """Encoder and decoder of one vocabulary, one rate and one seed."""

    def __init__(self, path: str = VOCABULARY, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=local_file(path))
        self.limit, self.seed = int(dropout * (1 << 32)), seed
        self.order: dict[str, tuple[float, int]] = {}
        self.byte = [0] * 256
        self.raw = [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte[b], self.raw[i] = i, bytes([b])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.order[piece], self.raw[i] = (-model.get_score(i), i), piece.replace(MARK, " ").encode()
        self._pairs()

    def _pairs(self) -> None:
        """Symbols (pieces by their ids, then other characters of pieces) and a hash table of the pairs that merge."""
        symbol = {p: i for p, (_, i) in self.order.items()}
        self.first_other = len(self.raw)
        for p in self.order:
            for c in p:
                symbol.setdefault(c, self.first_other + len(symbol) - len(self.order))
        self.other = {i: [self.byte[b] for b in p.encode()] for p, i in symbol.items() if i >= self.first_other}
        self.unknown = self.first_other + len(symbol)
        self.symbol_of = np.full(0x110000, self.unknown, np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.symbol_of[ord(MARK)] = self.unknown  # a mark in the text itself is no piece
        self.space = symbol.get(MARK, self.unknown)
        self.rank = np.zeros(len(self.raw), np.int64)
        at = {score: k for k, score in enumerate(sorted({score for score, _ in self.order.values()}))}
        for score, i in self.order.values():
            self.rank[i] = at[score]
        found = {(symbol[p[:k]] << 20) | symbol[p[k:]]: i for p, (_, i) in self.order.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol}
        key, value = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))
        self.bits = max(4, int(len(found) * 4).bit_length())
        self.pair, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        slot = self._slot(key)
        while len(key):
            free = np.flatnonzero(self.pair[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.pair[slot[put]], self.merged[slot[put]] = key[put], value[put]
            rest = np.ones(len(key), bool)
            rest[put] = False
            key, value, slot = key[rest], value[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _PLACE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _offer(self, left: np.ndarray, right: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged pieces and ranks of neighbours; rank _NONE where nothing merges or the draw skips it."""
        pair = (left << 20) | right
        slot = self._slot(pair)
        out = np.where(self.pair[slot] == pair, self.merged[slot], -1)
        open_ = np.flatnonzero((self.pair[slot] != pair) & (self.pair[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.pair[slot[open_]]
            hit = there == pair[open_]
            out[open_[hit]] = self.merged[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        rank = np.full(len(out), _NONE)
        at = np.flatnonzero(out >= 0)
        if self.limit:
            x = key[at] + place[at].astype(np.uint64) * _PLACE + out[at].astype(np.uint64) * _PIECE
            x = (x ^ (x >> np.uint64(30))) * _MIX1
            x = (x ^ (x >> np.uint64(27))) * _MIX2
            at = at[((x ^ (x >> np.uint64(31))) >> np.uint64(32)) >= np.uint64(self.limit)]
        rank[at] = self.rank[out[at]]
        return out, rank

    def _together(self, symbols: np.ndarray, starts: np.ndarray, n: int, keys: np.ndarray, places: np.ndarray) -> None:
        """Merge stretches of ``n`` characters in place; symbols that were merged into the one before become -1."""
        w = len(starts)
        index = starts[:, None] + np.arange(n)
        part = symbols[index].astype(np.int64)
        piece, rank = np.full((w, n), -1, np.int64), np.full((w, n), _NONE)
        left = np.broadcast_to(np.arange(n - 1), (w, n - 1))
        p, r = self._offer(part[:, :-1].ravel(), part[:, 1:].ravel(), np.repeat(keys, n - 1), (places[:, None] + left).ravel())
        piece[:, :-1], rank[:, :-1] = p.reshape(w, -1), r.reshape(w, -1)
        following, before = np.tile(np.arange(1, n + 1), (w, 1)), np.tile(np.arange(-1, n - 1), (w, 1))
        live = np.arange(w)
        while len(live):
            i = rank[live].argmin(axis=1)
            going = rank[live, i] < _NONE
            live, i = live[going], i[going]
            if not len(live):
                break
            j = following[live, i]
            part[live, i] = piece[live, i]
            part[live, j] = -1
            rank[live, j] = _NONE
            rank[live, i] = _NONE
            k = following[live, j]
            following[live, i] = k
            inner = k < n
            a, b = live[inner], k[inner]
            before[a, b] = i[inner]
            h = before[live, i]
            outer = h >= 0
            c = live[outer]
            row, one, two = np.concatenate((a, c)), np.concatenate((i[inner], h[outer])), np.concatenate((b, i[outer]))
            piece[row, one], rank[row, one] = self._offer(part[row, one], part[row, two], keys[row], places[row] + one)
        symbols[index] = part

    def encode_all(self, texts: list[str], documents: list[str]) -> list[bytes]:
        """As :meth:`encode`, for many texts."""
        out, low, size = [], 0, 0
        for high, t in enumerate(texts):
            if size and size + len(t) > CHARS:
                out += self._encode(texts[low:high], documents[low:high])
                low, size = high, 0
            size += len(t) + 1
        return out + self._encode(texts[low:], documents[low:])

    def _encode(self, texts: list[str], documents: list[str]) -> list[bytes]:
        codes = np.frombuffer("".join([" " + t for t in texts if t]).encode("utf-32-le"), "<u4")
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        begin = np.cumsum(sizes) - sizes
        names = [xxhash.xxh64_intdigest(f"{d}\0{t}".encode(), self.seed) for d, t in zip(documents, texts, strict=True)]
        space, line = codes == 32, codes == 10
        symbols = self.symbol_of[codes]
        symbols[space] = self.space
        head = line.copy()
        head[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        head[begin[sizes > 0]] = True
        starts = np.flatnonzero(head)
        length = np.diff(np.append(starts, len(codes)))
        text = np.searchsorted(begin + sizes, starts, side="right")
        places, keys = starts - begin[text], np.array(names, np.uint64)[text]
        order = np.argsort(length, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(length[order], prepend=-1)), len(order))
        result = symbols.astype(np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            n = int(length[order[a]])
            if 1 < n <= TOGETHER:
                for c in range(a, b, WIDE):
                    at = order[c : min(b, c + WIDE)]
                    self._together(result, starts[at], n, keys[at], places[at])
            elif n > TOGETHER:
                for k in order[a:b].tolist():
                    stretch = codes[starts[k] : starts[k] + n].astype("<u4").tobytes().decode("utf-32-le")
                    result[starts[k] : starts[k] + n] = self._alone(stretch, int(keys[k]), int(places[k]))
        bounds = np.append(begin, len(codes))
        kept = np.flatnonzero(result >= 0)
        many = np.ones(len(kept), np.int64)
        odd = np.flatnonzero(result[kept] >= self.first_other)
        spelled = {}
        if len(odd):
            for s, c in set(zip(result[kept[odd]].tolist(), codes[kept[odd]].tolist(), strict=True)):
                spelled[s, c] = self.other.get(s) or [self.byte[x] for x in chr(c).encode()]
            written = [spelled[p] for p in zip(result[kept[odd]].tolist(), codes[kept[odd]].tolist(), strict=True)]
            many[odd] = [len(x) for x in written]
        ids = np.repeat(result[kept], many)
        ends = np.concatenate(([0], np.cumsum(many)))
        if len(odd):
            long = np.repeat(np.isin(np.arange(len(kept)), odd), many)
            ids[long] = np.concatenate(written)
        at = ends[np.searchsorted(kept, bounds)]
        ids = ids.astype("<u4")
        return [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def _alone(self, stretch: str, key: int, place: int) -> np.ndarray:
        """Symbols of one stretch by an agenda; -1 for those that were merged into the one before."""
        # A mark in the text itself is no piece: it must not merge, nor be taken for a space.
        parts: list[str | None] = [MARK if c == " " else c if c != MARK else "\ue000" + c for c in stretch]
        n, order, agenda = len(parts), self.order, []
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            rank = order.get(both)
            if rank is not None:
                heapq.heappush(agenda, (rank[0], i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if parts[i] is None or following[i] != j or j >= n or parts[i] + parts[j] != both:
                continue
            if self.limit and self._draw(key, place + i, order[both][1]) < self.limit:
                continue
            parts[i], parts[j] = both, None
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        one = lambda p: -1 if p is None else order[p][1] if p in order else int(self.symbol_of[ord(p)]) if len(p) == 1 and p != MARK else self.unknown
        return np.fromiter(map(one, parts), np.int64, n)

    @staticmethod
    def _draw(key: int, place: int, piece: int) -> int:
        x = (key + place * 0x9E3779B97F4A7C15 + piece * 0xC2B2AE3D27D4EB4F) & _MASK
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
        return (x ^ (x >> 31)) >> 32

    def encode(self, text: str, document: str = "") -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; the vocabulary's leading space mark is put before it."""
        return self.encode_all([text], [document])[0]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:].decode()


_CODECS: dict[tuple, PieceCodec] = {}


def codec(*key) -> PieceCodec:
    """The worker's codec for (path, dropout, seed)."""
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(*key)
    return _CODECS[key]


def encode(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, path: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, lossless (decoding gave the text back) and, if asked for, ids.

    A null text is empty; an empty one has no ids. Whole texts are encoded,
    however long. Rows of one doc_id and text are encoded alike, and so are
    equal texts without an id; copies under other ids are not. Other columns
    aren't read, whatever their names, and an empty table gives an empty result.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, dropout, seed)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = own.encode_all(texts, [str(d) for d in batch.column("doc_id").to_pylist()])
                columns = [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([own.decode(x) == t for x, t in zip(ids, texts, strict=True)]),
                ]
                names = ["doc_id", "n_pieces", "ids_crc32", "lossless"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + ", ids binary" * with_ids
    return spread(docs.select("doc_id", "text")).mapInArrow(each, schema)


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids are an empty text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, 0.0, 0)
        for batch in batches:
            texts = [own.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(each, "doc_id long, text string")
