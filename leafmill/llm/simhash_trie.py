"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are made from whole texts, then only *distinct* fingerprints go
on, so a group of copies of any size is one row. Two fingerprints with at most
three differing bits agree on one of four blocks of bits: rows are dealt by
(block, value), and each such bucket is one binary trie that is joined with
itself. Node pairs are walked together, their differing bits add up, and a
pair over the budget is pruned with everything below it; a pair whose leaves
are known to be linked already is pruned too, so a dense ball of fingerprints
costs far less than its pairs, and only a spanning forest leaves a task.
Buckets over ``SPLIT`` rows are dealt again by four blocks of the bits that are
left, and so on, which is exact for the same reason and ends, as distinct
fingerprints with 16 bits left are few. A task holds a bucket or a few at a
time. Components over all buckets come from alternating large-star and
small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_tables, lower_bytes, materialise, numbered, plain_columns, ragged, slices, spread, words_of

BUDGET = 3
#: Rows of a bucket from which it is dealt again by further blocks.
SPLIT = 50_000
#: Bits left in a bucket from which it isn't dealt again: it has 65,536 rows at most.
LEAST_BITS = 16
#: Rows of whole buckets that are joined together, at least; leaf pairs that are compared, and node pairs that are expanded, at once.
TOGETHER, CHUNK = 20_000, 100_000
#: Bytes of text from which fingerprints are made together, unless one text is longer.
TEXTS = 2_000_000
#: Node pairs with at most so many leaf pairs are compared directly.
SMALL = 32


def shingle_hashes(words: list[bytes], width: int = 3) -> np.ndarray:
    """XXH64, seed 42, of every shingle; fewer words than ``width``: of the whole sequence; none: empty."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    ends = (starts + lengths)[width - 1 :].tolist()
    cuts = map(line.__getitem__, map(slice, starts[: n - width + 1].tolist(), ends))
    return np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(42)), np.uint64, n - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if set in over half the hashes; no hash: 0."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[a : a + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", TEXTS):
            offsets, ids, distinct = words_of(batch.column("text"))
            lowered = np.array([*lower_bytes(distinct.to_pylist()), b""], dtype=object)
            marks = [fingerprint(shingle_hashes(lowered[ids[a:b]].tolist())) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            fp = np.array(marks, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(fp)], ["doc_id", "row", "fp"])


def fingerprints(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, row (the column of that name, else 0) and the 64-bit fingerprint of each whole text, as a signed long."""
    number = F.lit(0).cast("long") if row is None else F.col(row)
    return spread(docs.select("doc_id", number.alias("row"), "text")).mapInArrow(_fingerprints, "doc_id long, row long, fp long")


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (smallest index) after linking i[k] with j[k]."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        parent = np.arange(len(label), dtype=label.dtype)
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up
        label = parent[label]


def trie_components(bucket: np.ndarray, fp: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """Component of each row among the rows of its bucket, named by a row number.

    Rows must be sorted by (bucket, fp as unsigned). A node of a bucket's trie
    is a range of rows that share their leading bits.
    """
    n = len(fp)
    label = np.arange(n, dtype=np.int32)
    if n < 2:
        return label
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).astype(np.int32)
    size = np.diff(np.append(first, np.int32(n)))
    first, size = first[size > 1], size[size > 1]
    stack = [(0, np.stack((first, first + size, first, first + size, np.zeros_like(first))))]
    zeros: dict[int, np.ndarray] = {}
    changes = np.arange(n, dtype=np.int32)
    while stack:
        depth, pairs = stack.pop()
        alo, ahi, blo, bhi, _ = pairs
        # Leaves that are linked already need no further link.
        known = (changes[alo] == changes[ahi - 1]) & (changes[blo] == changes[bhi - 1]) & (label[alo] == label[blo])
        known &= (ahi - alo > 1) | (blo != alo)
        pairs = pairs[:, ~known & ~((alo == blo) & (ahi - alo == 1))]
        if not pairs.shape[1]:
            continue
        if pairs.shape[1] > CHUNK:
            half = pairs.shape[1] // 2
            stack += [(depth, pairs[:, half:].copy()), (depth, pairs[:, :half].copy())]
            continue
        alo, ahi, blo, bhi, _ = pairs
        leaves = (ahi - alo).astype(np.int64) * (bhi - blo)
        small = (leaves <= SMALL) | (depth == 64)
        if small.any():
            label = _compare(fp, label, pairs[:, small], leaves[small], budget)
            changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1]))).astype(np.int32)
        pairs = pairs[:, ~small]
        if not pairs.shape[1]:
            continue
        if depth not in zeros:
            bit = (fp >> np.uint64(63 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate(([0], np.cumsum(bit == 0))).astype(np.int32)
        z = zeros[depth]
        alo, ahi, blo, bhi, err = pairs
        am, bm = alo + z[ahi] - z[alo], blo + z[bhi] - z[blo]
        own = alo == blo
        # Links inside a node are found before those between nodes, which they may make needless.
        halves = [(alo, am, blo, bm, err), (am, ahi, bm, bhi, err), (alo, am, bm, bhi, err + 1), tuple(x[~own] for x in (am, ahi, blo, bm, err + 1))]
        inner, outer = [], []
        for part in map(np.stack, halves):
            part = part[:, (part[0] < part[1]) & (part[2] < part[3]) & (part[4] <= budget)]
            same = part[0] == part[2]
            inner.append(part[:, same])
            outer.append(part[:, ~same])
        stack += [(depth + 1, x) for x in (np.concatenate(outer, axis=1), np.concatenate(inner, axis=1)) if x.shape[1]]
    return label


def _compare(fp: np.ndarray, label: np.ndarray, pairs: np.ndarray, leaves: np.ndarray, budget: int) -> np.ndarray:
    """Labels after comparing all leaf pairs of the node pairs, in portions."""
    ends = np.cumsum(leaves)
    start = 0
    while start < len(leaves):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + CHUNK, side="right")))
        alo, _, blo, bhi, _ = pairs[:, start:stop]
        down, across = np.divmod(ragged(np.zeros(stop - start, np.int64), leaves[start:stop]), np.repeat(bhi - blo, leaves[start:stop]))
        i = np.repeat(alo, leaves[start:stop]) + down
        j = np.repeat(blo, leaves[start:stop]) + across
        near = (i < j) & (np.bitwise_count(fp[i] ^ fp[j]) <= budget)
        label = _union(label, i[near], j[near])
        start = stop
    return label


def _joined(mask: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    """Links of whole buckets: a spanning forest of each."""
    fp = fp.view(np.uint64)
    order = np.lexsort((fp, value, mask))
    mask, value, fp = mask[order], value[order], fp[order]
    bucket = np.cumsum(np.concatenate(([True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))))
    label = trie_components(bucket, fp)
    i = np.flatnonzero(label != np.arange(len(label)))
    a, b = fp[i].view(np.int64), fp[label[i]].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each bucket; rows come in the order of their buckets."""
    waiting: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        waiting.append([batch.column(n).to_numpy() for n in ("mask", "value", "fp")])
        rows += batch.num_rows
        if rows < TOGETHER:
            continue
        mask, value, fp = (np.concatenate(x) for x in zip(*waiting, strict=True))
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
        last = int(new[-1]) if len(new) else 0  # the last bucket may go on
        if last:
            yield _joined(mask[:last], value[:last], fp[:last])
        waiting, rows = [[x[last:].copy() for x in (mask, value, fp)]], len(fp) - last
    if rows:
        yield _joined(*(np.concatenate(x) for x in zip(*waiting, strict=True)))


def deeper(mask: int) -> list[int]:
    """The masks that fix, besides the bits of ``mask``, one of BUDGET + 1 blocks of the others."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in part) for part in np.array_split(free, BUDGET + 1)]


def _long(x: int):
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def links(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links (u > v) among distinct fingerprints that span every component of at most BUDGET differing bits."""
    masks, done = deeper(0), []
    value = F.col("fp").bitwiseAND(F.col("mask")).alias("value")
    dealt = distinct.select("fp", F.explode(F.array(*map(_long, masks))).alias("mask")).select("fp", "mask", value)
    while min(64 - m.bit_count() for m in masks) > LEAST_BITS:
        hot = materialise(dealt.groupBy("mask", "value").count().where(F.col("count") > split).select("mask", "value", F.lit(True).alias("hot")))
        if hot.isEmpty():
            break
        marked = dealt.join(hot, ["mask", "value"], "left")
        done.append(marked.where("hot IS NULL").select("fp", "mask", "value"))
        following = F.element_at(F.map_from_arrays(F.array(*map(_long, masks)), F.array(*[F.array(*map(_long, deeper(m))) for m in masks])), F.col("mask"))
        again = marked.where("hot").select("fp", F.explode(following).alias("mask")).distinct()  # two ways may lead to one mask
        dealt = materialise(again.select("fp", "mask", value))
        masks = sorted({x for m in masks for x in deeper(m)})
    for part in done:
        dealt = dealt.unionByName(part)
    return dealt.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(_links, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link: the smallest node it can reach.

    Alternates large-star and small-star until all that is left are stars.
    Group minima are written before they are joined, so both sides of every
    join are plain exchanges and a hub's rows can be split.
    """
    spark, edges = edges.sparkSession, materialise(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialise(large.distinct())
        hub = materialise(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(hub, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(moved.union(hub.select("u", F.col("m").alias("v"))).distinct())
        drop_tables(spark, edges, least, large, hub)
        edges = after
        inner = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if inner.isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _named(marks: DataFrame) -> DataFrame:
    """fp and first (lost: whether no row has an id; doc_id, row: the smallest) of each fingerprint's component."""
    row = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "row")
    distinct = materialise(marks.groupBy("fp").agg(F.min(row).alias("first")))
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    rooted = materialise(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")))
    names = materialise(rooted.groupBy("root").agg(F.min("first").alias("first")))
    return materialise(rooted.select("fp", "root").join(names, "root").select("fp", "first"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, a row for each row.

    ``component_id`` is the smallest doc_id that is reachable by links of at
    most three differing bits; null ids don't count, and a component without
    any other has null. Null, empty and blank texts have fingerprint zero,
    which links like any other; a text of one or two words is one shingle.
    Rows that repeat a doc_id are nodes of their own with equal ids. Columns
    other than doc_id and text aren't read, so their names don't matter; an
    empty table gives an empty result.
    """
    marks = materialise(fingerprints(docs), "fingerprints")
    return marks.join(_named(marks), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of near duplicates, all columns: the one with the smallest doc_id.

    Rows without an id come after all others; of rows with one id, or none,
    the first written stays, so exactly one row of a component does. Null,
    empty and blank texts are one component with all that links to fingerprint
    zero. Any further columns are carried along, whatever their names; an empty
    table gives an empty result.
    """
    table, row = numbered(docs)
    marks = materialise(fingerprints(table, row), "fingerprints")
    kept = materialise(_named(marks).select(F.col("first.row").alias(row)).distinct())
    # Row numbers grow with the rows, so they are never broadcast.
    return table.join(kept.hint("shuffle_hash"), row, "left_semi").select(*plain_columns(docs))
