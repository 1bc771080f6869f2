"""SimHash near-duplicates by vantage-point trees over Hamming distance.

1. *Fingerprints.* All words of a text, lower-cased in A-Z, are laid end to end; each n-word shingle is a span of that buffer and
   gets its XXH64 (seed 42). A bit of the fingerprint is set where it is set in over half of the text's shingle hashes.
2. *Shards.* Documents of one fingerprint are one point. A vantage point splits the points of a node into those within a radius and those
   beyond it. Two points within ``bits`` of each other whose distances to the vantage point lie on both sides of the radius cannot be
   further beyond it than ``bits`` (triangle bound), so the points of that margin also go to the inner side, and every other branch is
   pruned. Nodes above ``SHARD`` points are split again, several levels a round, as joins; the trees of a round are grown in Spark tasks,
   each on a sample of its node's points, which only steers the split: all points are routed.
3. *Pairs.* Each shard goes on with the same split in memory, down to leaves that are compared pair by pair, so every pair within
   ``bits`` is met in at least one leaf. A shard gives the links that join its components, at most one a point; no other link joins anything new.
4. *Components* by smallest labels with pointer jumping, as joins. Nothing of it reaches the driver.

On fingerprints without structure a split in two keeps some 0.65 of the points on either side, so the work grows as their number to the
power 1.6; that is the price of triangle bounds at distances around 32.

Defined results: NULL and empty texts, and texts without words, have fingerprint zero and are linked like any other; a text of fewer
than ``n`` words has its whole word sequence as its one shingle; repeated shingles count as often as they stand; a bit set in exactly half of the hashes is
not set; repeated rows are members each; rows without an id are members, but a component takes its name from the ids it has (NULL if none);
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from funnelspark.llm import frames
from funnelspark.llm.ngram_join import components
from funnelspark.llm.ragged import LOWER, NOT_SPACE, text_bytes, word_spans
from funnelspark.session import materialise

#: Points a shard is meant to hold; a node is split where it holds twice as many.
SHARD = 16_384
#: Levels of splits in one round, and sampled points for each of the lowest nodes of a tree.
LEVELS, PER_LEAF = 6, 32
#: Points compared pair by pair.
LEAF = 256
#: Natural logarithm of the share of points that a side of a split is expected to keep.
_SHRINK = 0.43
#: A split that leaves more than this share on one side is no progress.
_STUCK = 0.95

# Fixed values of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(v) for v in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of the spans of a byte array, all spans a step at a time."""
    order = np.argsort(-size, kind="stable")
    at, size = start[order].astype(np.int64), size[order].astype(np.int64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    wide = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    half = np.ndarray((len(data) + 1,), "<u4", padded, 0, (1,))
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(at), seed + _P5, np.uint64)
        long = int(np.searchsorted(-size, -32, "right"))
        if long:
            lanes = [np.full(long, v, np.uint64) for v in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
            for k in range(int(size[0]) // 32):
                m = int(np.searchsorted(-size, -32 * (k + 1), "right"))
                for i, lane in enumerate(lanes):
                    lane[:m] = _turn(lane[:m] + wide[at[:m] + 32 * k + 8 * i] * _P2, 31) * _P1
            mixed = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                mixed = (mixed ^ (_turn(lane * _P2, 31) * _P1)) * _P1 + _P4
            h[:long] = mixed
        h += size.astype(np.uint64)
        at, left = at + size // 32 * 32, size % 32
        for _ in range(3):
            some = np.flatnonzero(left >= 8)
            h[some] = _turn(h[some] ^ (_turn(wide[at[some]] * _P2, 31) * _P1), 27) * _P1 + _P4
            at[some] += 8
            left[some] -= 8
        some = np.flatnonzero(left >= 4)
        h[some] = _turn(h[some] ^ (half[at[some]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[some] += 4
        left[some] -= 4
        for k in range(3):
            some = np.flatnonzero(left > k)
            h[some] = _turn(h[some] ^ (padded[at[some] + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
    out = np.empty_like(h)
    out[order] = h
    return out


def _majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprint of each group of hashes; ``first`` holds where the groups begin (none is empty)."""
    size = np.diff(np.append(first, len(h)))
    # Bits are counted in eight byte lanes of a word, in pieces of at most 255 hashes that cannot overflow.
    pieces = -(-size // 255)
    owner = np.repeat(np.arange(len(first)), pieces)
    cut = first[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    out = np.zeros((len(first), 64), bool)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & np.uint64(0x0101010101010101), cut).view(np.uint8).reshape(-1, 8)
        out[:, k::8] = 2 * np.add.reduceat(lanes, edge, axis=0, dtype=np.int64) > size[:, None]
    return np.packbits(out, axis=1, bitorder="little").view("<u8")[:, 0]


def text_fingerprints(column: pa.Array, n: int = 3) -> np.ndarray:
    """Fingerprint of each text of a slice."""
    data, offsets = text_bytes(column)
    inside = NOT_SPACE[data]
    start, end, row = word_spans(data, offsets, inside)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(start):
        return out
    size = end - start
    begin = np.cumsum(size + 1) - size - 1  # words with one space after each
    laid = np.full(int(begin[-1] + size[-1]) + 1, 32, np.uint8)
    laid[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = LOWER[data[inside]]
    rows, first, count = np.unique(row, return_index=True, return_counts=True)
    shingles = np.maximum(count - n + 1, 1)
    base = np.cumsum(shingles) - shingles
    a = np.repeat(first, shingles) + np.arange(int(shingles.sum())) - np.repeat(base, shingles)
    b = a + np.repeat(np.minimum(count, n), shingles) - 1
    out[rows] = _majority(xxh64(laid, begin[a], begin[b] + size[b] - begin[a]), base)
    return out


def fingerprints(docs: DataFrame, n: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, print) of every row; ``print`` holds the 64 bits as a whole number."""
    make = lambda: lambda column: [text_fingerprints(column, n).view(np.int64)]
    return frames.append(docs.select("doc_id", text), text, [("print", T.LongType())], make).select("doc_id", "print")


def _split(points: np.ndarray, bits: int, tries: int) -> tuple[np.uint64, int, np.ndarray]:
    """Vantage point, radius and distances: of evenly spaced candidates the one with the widest spread, halved as evenly as it goes."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, min(tries, len(points))).astype(np.int64)]:
        far = np.bitwise_count(points ^ v)
        upto = np.cumsum(np.bincount(far, minlength=66 + bits))
        larger = np.maximum(upto[bits : 65 + bits], len(points) - upto[:65])  # inner side with its margin, outer side
        radius = int(np.argmin(larger))
        if best is None or larger[radius] < best[0]:
            best = (int(larger[radius]), v, radius, far)
    return best[1], best[2], best[3]


_TREE = pa.schema([("node", pa.int64()), ("vantage", pa.int64()), ("radius", pa.int32())])


def _grow(table: pa.Table, bits: int) -> pa.Table:
    """Splits below one node from its sampled points; children of node x are 2x and 2x + 1."""
    if not table.num_rows:
        return _TREE.empty_table()
    levels, root = table.column("levels")[0].as_py(), table.column("node")[0].as_py()
    rows, nodes = [], [(root, np.unique(np.asarray(table.column("print")).view(np.uint64)))]
    for _ in range(levels):
        below = []
        for node, points in nodes:
            if len(points) < 4:
                continue
            v, radius, far = _split(points, bits, 8)
            if not (far > radius).any():
                continue
            rows.append((node, int(v.view(np.int64)), radius))
            below += [(2 * node, points[far <= radius + bits]), (2 * node + 1, points[far > radius])]
        nodes = below
    return pa.Table.from_arrays([pa.array(list(c)) for c in zip(*rows)], schema=_TREE) if rows else _TREE.empty_table()


def shards(points: DataFrame, bits: int = 3, shard: int = SHARD) -> DataFrame:
    """(node, print): the shards that each distinct ``print`` belongs to, so that any two within ``bits`` share one."""
    placed, done = points.select(F.lit(1).cast("long").alias("node"), "print", F.lit(0).cast("long").alias("was")), None
    while True:
        placed = materialise(placed, "simhash-placed")
        counts = materialise(placed.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.max("was").alias("was")), "simhash-counts")
        large = counts.where((F.col("rows") > 2 * shard) & ((F.col("was") == 0) | (F.col("rows") < _STUCK * F.col("was"))) & (F.col("node") < 1 << 55))
        levels = F.least(F.lit(LEVELS), F.ceil(F.log(F.col("rows") / shard) / _SHRINK)).cast("int")
        large = large.select(F.col("node").alias("_node"), "rows", levels.alias("levels"))
        if large.isEmpty():
            final = placed.select("node", "print")
            return final if done is None else done.union(final)
        wanted = PER_LEAF * F.pow(F.lit(2.0), F.col("levels")) / F.col("rows")
        picked = F.pmod(F.xxhash64("print", "node"), F.lit(1 << 20)) < wanted * (1 << 20)
        sample = placed.join(large, F.col("node") == F.col("_node")).where(picked).select("node", "print", "levels")
        trees = materialise(sample.groupBy("node").applyInArrow(lambda t: _grow(t, bits), "node long, vantage long, radius int"), "simhash-trees")
        trees = trees.withColumnRenamed("node", "_at")
        stay = placed.join(large, F.col("node") == F.col("_node"), "left_anti").select("node", "print")
        done = stay if done is None else done.union(stay)
        moved = placed.join(large, F.col("node") == F.col("_node")).select("node", "print", F.col("rows").alias("was"))
        far = F.bit_count(F.col("print").bitwiseXOR(F.col("vantage")))
        inner, outer = 2 * F.col("node"), 2 * F.col("node") + 1
        sides = (
            F.when(F.col("vantage").isNull(), F.array("node")).when(far <= F.col("radius"), F.array(inner))
            .when(far <= F.col("radius") + bits, F.array(inner, outer)).otherwise(F.array(outer))
        )
        for _ in range(LEVELS):
            moved = moved.join(trees, F.col("node") == F.col("_at"), "left").select(F.explode(sides).alias("node"), "print", "was")
        placed = moved


class _Labels:
    """Components of points by smallest index; links are merged in batches."""

    def __init__(self, n: int):
        self.label, self.held, self.count = np.arange(n), [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        other = self.label[a] != self.label[b]
        self.held.append((a[other], b[other]))
        self.count += int(other.sum())
        if self.count > 1 << 20:
            self.merge()

    def merge(self) -> np.ndarray:
        label = self.label
        a, b = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 2
        while len(a):
            x, y = label[a], label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label[:] = label[label]
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
        self.held, self.count = [], 0
        return label


def _compare(points: np.ndarray, index: np.ndarray, bits: int, labels: _Labels) -> None:
    """All pairs of a leaf, a block of rows at a time."""
    block = max(1, (1 << 22) // len(index))
    for a in range(0, len(index), block):
        near = np.bitwise_count(points[index[a : a + block], None] ^ points[index[None, a:]]) <= bits
        i, j = np.nonzero(near)
        up = j > i
        labels.add(index[a + i[up]], index[a + j[up]])


def joining_links(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each point of a component to its first point; components of points within ``bits``, by a vantage-point tree in memory."""
    labels, nodes = _Labels(len(points)), [np.arange(len(points))]
    while nodes:
        index = nodes.pop()
        if len(index) < 2:
            continue
        if len(index) > LEAF:
            _, radius, far = _split(points[index], bits, 4)
            inner, outer = index[far <= radius + bits], index[far > radius]
            if max(len(inner), len(outer)) <= _STUCK * len(index):
                nodes += [inner, outer]
                continue
        _compare(points, index, bits, labels)
    label = labels.merge()
    other = np.flatnonzero(label != np.arange(len(points)))
    return points[other], points[label[other]]


def links(points: DataFrame, bits: int = 3, shard: int = SHARD) -> DataFrame:
    """(a, b): pairs of distinct ``print`` values within ``bits`` that join all components of such pairs."""

    def run(table: pa.Table) -> pa.Table:
        a, b = joining_links(np.unique(np.asarray(table.column("print")).view(np.uint64)), bits)
        return pa.Table.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return shards(points, bits, shard).groupBy("node").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = 3, bits: int = 3, text: str = "text", shard: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row: components of fingerprints that differ in at most ``bits`` bits."""
    rows = materialise(fingerprints(docs, n, text), "simhash-prints")
    points = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-points")
    labels = components(links(points, bits, shard), "simhash").withColumnRenamed("key", "_print")
    named = points.join(labels, F.col("print") == F.col("_print"), "left").select("print", "least", F.coalesce("label", "print").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    # Written first: Spark knows the size when it plans the join below, and a print that many rows share is no key of a shuffle while it is small.
    names = materialise(named.join(least, "label").select(F.col("print").alias("_print"), "component_id"), "simhash-names")
    return rows.join(names, F.col("print") == F.col("_print")).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
