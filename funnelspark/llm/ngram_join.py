"""N-gram Jaccard join as a blocked sparse matrix product of the document by n-gram incidence.

1. *Incidence.* Each text's distinct word n-grams are 64-bit hashes. Documents of one and the same n-gram set are one row of the
   matrix (its key is a hash of the set). Entries travel packed, by column block (hash range): some 9 bytes each.
2. *Column blocks.* A block drops columns with a single row; what is left goes back by row with its column's frequency.
   For each class of partner sizes a row counts the columns in which it meets such partners; classes in which this is below the
   bound that the two sizes give are discarded, and with them columns and whole rows.
3. *Product.* Rows order their columns by frequency; a pair that reaches its bound must meet in both rows' first columns, so only
   these are multiplied. A first product pairs the rows of a column with its most connected row and keeps each row's partner with
   the largest partial count; overlaps are counted and links that reach ``percent * union`` join components. A second product covers every pair of rows of
   different components, so no link that could change a component is left out, and near copies are not paired all with all.
4. *Components* by smallest labels with pointer jumping, as joins; nothing of it reaches the driver.
5. *All links*, where they are asked for: every pair of rows that meet in their first columns is verified, whatever component it is in.
   The rows of a column are dealt into cells and meet cell by cell, so no task holds a hot column. As many pairs come out as there are.

Defined results: NULL and empty texts have no n-grams and are linked with nothing (their component is their own id); a text of
fewer than ``n`` words has its whole word sequence as its one n-gram; repeated rows are one row of the matrix; rows without an id
count as members, but a component takes its name from the ids it has (NULL if none); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from funnelspark.llm.ragged import LOWER, NOT_SPACE, mix, slices, text_bytes, word_hashes, word_spans
from funnelspark.session import materialise

#: Matrix entries that a task packs at a time.
FLUSH = 1_000_000
#: Size classes up and down that a partner can be away.
CLASSES = 6
#: Candidate pairs formed at a time inside a column block.
CHUNK = 1 << 20
#: Rows of a column that meet at a time where all links are asked for; hotter columns are dealt into cells of about so many.
CELL = 1000
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: ``extra`` is per entry; ``more`` per row of the matrix: document ids (kind 0) or how connected it is.
PACKED = "kind int, block int, keys binary, sizes binary, at binary, hashes binary, extra binary, more array<bigint>"
_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in ("keys", "sizes", "at", "hashes", "extra")), ("more", pa.list_(pa.int64()))])


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    data, offsets = text_bytes(column)
    inside = NOT_SPACE[data]
    start, end, row = word_spans(data, offsets, inside)
    h = word_hashes(LOWER[data], start, end, inside)
    count = np.bincount(row, minlength=len(offsets) - 1)
    rolled = h[: max(len(h) - n + 1, 0)].copy()
    for k in range(1, n):
        rolled = rolled * _STEP + h[k : len(h) - n + 1 + k]
    rolled = mix(rolled)
    first = 0
    for c in count.tolist():
        if c >= n:
            yield np.unique(rolled[first : first + c - n + 1])
        elif c:
            whole = np.array([c], np.uint64)
            for x in range(first, first + c):
                whole = whole * _STEP + h[x : x + 1]
            yield mix(whole)
        else:
            yield h[:0]
        first += c


def set_key(s: np.ndarray) -> int:
    """Hash of a set of hashes."""
    total = np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D)), keepdims=True)
    return int(mix(total * np.uint64(2) + np.uint64(len(s)))[0].view(np.int64))


def _block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)


def _pack(kind: int, block: np.ndarray, keys: np.ndarray, sizes: np.ndarray, at: np.ndarray, hashes: np.ndarray, extra: np.ndarray | None, more: np.ndarray | None = None) -> pa.RecordBatch | None:
    """One row per block: its entries, and the matrix rows they belong to."""
    order = np.argsort(block, kind="stable")
    block, at, hashes, extra = block[order], at[order], hashes[order], None if extra is None else extra[order]
    cut = np.flatnonzero(np.diff(block)) + 1
    cols: list[list] = [[] for _ in _SCHEMA.names]
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
        if a == b:
            continue
        own, local = np.unique(at[a:b], return_inverse=True)
        row = (kind, int(block[a]), keys[own].tobytes(), sizes[own].tobytes(), local.astype(np.uint32 if len(own) > 65535 else np.uint16).tobytes(), hashes[a:b].tobytes(), b"" if extra is None else extra[a:b].tobytes(), None if more is None else more[own].tolist())
        for c, v in zip(cols, row):
            c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _SCHEMA.types)], schema=_SCHEMA) if cols[0] else None


def _short(h: np.ndarray) -> np.ndarray:
    """The lower seven bytes of hashes; the block that they travel to tells most of the eighth."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]


def _long(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 7, 8), np.uint8)
    wide[:, :7] = np.frombuffer(raw, np.uint8).reshape(-1, 7)
    return wide.view("<u8").reshape(-1)


class _Entries:
    """All entries of the packed rows of one group."""

    def __init__(self, table: pa.Table, extra, short: bool = False) -> None:
        keys, sizes, hashes, extras, more = [], [], [], [], []
        for k, s, a, h, e, m in zip(*(table.column(c).to_pylist() for c in ("keys", "sizes", "at", "hashes", "extra", "more"))):
            k, s, h = np.frombuffer(k, np.int64), np.frombuffer(s, np.int32), _long(h) if short else np.frombuffer(h, np.uint64)
            a = np.frombuffer(a, np.uint32 if len(k) > 65535 else np.uint16)
            keys.append(k[a])
            sizes.append(s[a])
            hashes.append(h)
            extras.append(np.frombuffer(e, extra) if e else np.zeros(len(h), extra))
            more.append(np.array(m, np.int64)[a] if m else np.zeros(len(h), np.int64))
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.key, self.size, self.hash, self.extra = join(keys, np.int64), join(sizes, np.int32), join(hashes, np.uint64), join(extras, extra)
        self.more = join(more, np.int64)

    def take(self, order) -> None:
        self.key, self.size, self.hash, self.extra = self.key[order], self.size[order], self.hash[order], self.extra[order]
        self.more = self.more[order]


def incidence(docs: DataFrame, blocks: int, n: int, text: str) -> DataFrame:
    """Packed entries by column block (kind 1), and (key, size, ids) of the rows (kind 0, under negative blocks)."""

    def run(batches):
        keys, sizes, ids, sets, held, seen = [], [], [], [], 0, {}

        def flush():
            nonlocal keys, sizes, ids, sets, held, seen
            if keys:
                block = -1 - (abs(keys[0]) % blocks)
                row = [[0], [block], [np.array(keys, np.int64).tobytes()], [np.array(sizes, np.int32).tobytes()], [b""], [b""], [b""], [ids]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _SCHEMA.types)], schema=_SCHEMA)
            if sets:
                own = np.fromiter(seen, np.int64, len(seen))
                size = np.array([len(s) for s in sets], np.int32)
                h = np.concatenate(sets)
                yield _pack(1, _block_of(h, blocks), own, size, np.repeat(np.arange(len(own)), size), _short(h), None)
            keys, sizes, ids, sets, held, seen = [], [], [], [], 0, {}

        for batch in batches:
            for part in slices(batch, text):
                for i, s in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column(text), n)):
                    key = set_key(s) if len(s) else 0
                    keys.append(key)
                    sizes.append(len(s))
                    ids.append(i)
                    if len(s) and key not in seen:
                        seen[key] = True
                        sets.append(s)
                        held += len(s)
                    if held >= FLUSH:
                        yield from flush()
        yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, PACKED)


def _size_class(size: np.ndarray, percent: int) -> tuple[np.ndarray, float]:
    """Class of a set size, and the ratio of class edges: sizes that can reach ``percent`` are at most ``CLASSES`` apart."""
    ratio = (100 / percent) ** (1 / (CLASSES - 0.1)) if percent < 100 else 1.5
    return np.floor(np.log(np.maximum(size, 1)) / np.log(ratio) + 1e-9).astype(np.int64), ratio


def _needs(size: np.ndarray, percent: int) -> np.ndarray:
    """Overlap that a row needs with the smallest partner of each relative size class (columns: -CLASSES to CLASSES)."""
    own, ratio = _size_class(size, percent)
    edge = np.ceil(ratio ** (own[:, None] + np.arange(-CLASSES, CLASSES + 1.0))) - 1
    partner = np.maximum(edge, np.ceil(size[:, None] * percent / 100 - 1e-6))
    return np.maximum(np.ceil((size[:, None] + partner) * percent / (100 + percent) - 1e-6), 1)


def _frequent(key, table: pa.Table, buckets: int, percent: int) -> pa.Table:
    """A column block without its columns of one row; entries go out by bucket of rows.

    Each carries its column's frequency (16 bits) and the relative size classes of the other rows in the column (a bit each).
    """
    if key[0].as_py() < 0:
        return table.cast(_SCHEMA)
    e = _Entries(table, np.uint8, short=True)
    # One to one within the block, and spread over all 64 bits again.
    e.hash = mix(e.hash | np.uint64(key[0].as_py() & 255) << np.uint64(56))
    order = np.argsort(e.hash, kind="stable")
    h = e.hash[order]
    same = h[1:] == h[:-1]
    order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    order = order[np.lexsort((e.key[order], e.hash[order]))]
    e.take(order)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (e.hash[1:] != e.hash[:-1]) | (e.key[1:] != e.key[:-1])
    e.take(fresh)
    if not len(e.key):
        return _SCHEMA.empty_table()
    column = np.cumsum(np.concatenate(([0], e.hash[1:] != e.hash[:-1])))
    frequency = np.bincount(column)[column]
    e.take(frequency > 1)
    column, frequency = column[frequency > 1], np.minimum(frequency[frequency > 1], 65535).astype(np.uint32)
    place = column * (1 << 20) + _size_class(e.size, percent)[0] + CLASSES
    held, count = np.unique(place, return_counts=True)
    for k in range(-CLASSES, CLASSES + 1 if len(held) else -CLASSES):
        at = np.minimum(np.searchsorted(held, place + k), len(held) - 1)
        met = (held[at] == place + k) & (count[at] > (k == 0))
        frequency |= met.astype(np.uint32) << np.uint32(16 + k + CLASSES)
    keys, first, at = np.unique(e.key, return_index=True, return_inverse=True)
    packed = _pack(1, (e.key.view(np.uint64) % np.uint64(buckets)).astype(np.int32), keys, e.size[first], at, e.hash, frequency)
    return pa.Table.from_batches([packed] if packed else [], _SCHEMA)


SETS = "key long, size int, need int, weight long, hashes binary"
_SETS = pa.schema([("key", pa.int64()), ("size", pa.int32()), ("need", pa.int32()), ("weight", pa.int64()), ("hashes", pa.binary())])


def _rows(key, table: pa.Table, percent: int) -> pa.Table:
    """The matrix rows of a bucket that could reach a size bound: columns of partners within reach, rarest first."""
    e = _Entries(table, np.uint32)
    frequency = e.extra & np.uint32(0xFFFF)
    e.take(np.lexsort((e.hash, frequency, e.key)))
    if not len(e.key):
        return _SETS.empty_table()
    cut = np.flatnonzero(np.concatenate(([True], e.key[1:] != e.key[:-1])))
    size, classes = e.size[cut], e.extra >> np.uint32(16)
    needs = _needs(size.astype(np.int64), percent)
    reach, need = np.zeros(len(cut), np.uint32), np.full(len(cut), np.inf)
    for k in range(2 * CLASSES + 1):
        good = np.add.reduceat(classes >> np.uint32(k) & np.uint32(1), cut, dtype=np.int64) >= needs[:, k]
        reach |= good.astype(np.uint32) << np.uint32(k)
        need = np.where(good, np.minimum(need, needs[:, k]), need)
    row = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(e.key))))
    keep = (classes & reach[row]) > 0
    weight = np.bincount(row[keep], (e.extra & np.uint32(0xFFFF))[keep], len(cut)) * 1000 / size
    edge = np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(cut)))))
    h, good = e.hash[keep], np.flatnonzero(reach)
    return pa.Table.from_arrays([
        pa.array(e.key[cut[good]], pa.int64()), pa.array(size[good], pa.int32()), pa.array(need[good].astype(np.int32)), pa.array(weight[good].astype(np.int64)),
        pa.array([h[edge[i] : edge[i + 1]].tobytes() for i in good], pa.binary()),
    ], schema=_SETS)


def first_columns(sets: DataFrame, blocks: int) -> DataFrame:
    """Packed first columns of each row of (key, size, need, weight, hashes, label): so many that any partner at the bound shares one."""

    def run(batches):
        held: list[tuple] = []
        entries = 0

        def flush():
            nonlocal held, entries
            if held:
                keys, sizes, weights, labels, lengths, sets = zip(*held)
                size = np.array([len(s) for s in sets], np.int32)
                h = np.concatenate(sets)
                extra = np.empty(len(h), _ENTRY)
                extra["label"] = np.repeat(np.array(labels, np.int64), size)
                # Columns of the row from this one on: what a pair that first meets here can still share.
                extra["left"] = np.repeat(np.array(lengths) + np.cumsum(size) - size, size) - np.arange(len(h))
                packed = _pack(1, _block_of(h, blocks), np.array(keys, np.int64), np.array(sizes, np.int32), np.repeat(np.arange(len(size)), size), h, extra, np.array(weights, np.int64))
                if packed:
                    yield packed
            held, entries = [], 0

        for batch in batches:
            for k, n, need, weight, raw, label in zip(*(c.to_pylist() for c in batch.columns)):
                h = np.frombuffer(raw, np.uint64)
                held.append((k, n, weight, label, len(h), h[: len(h) - need + 1]))
                entries += len(held[-1][-1])
                if entries >= FLUSH:
                    yield from flush()
        yield from flush()

    return sets.select("key", "size", "need", "weight", "hashes", "label").mapInArrow(run, PACKED)


_ENTRY = np.dtype([("label", np.int64), ("left", np.int32)])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("met", pa.int32())])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.Table:
    if not len(a):
        return _PAIRS.empty_table()
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return pa.Table.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(np.diff(np.append(first, len(a))), pa.int32())], schema=_PAIRS)


def _columns(table: pa.Table) -> tuple[_Entries, np.ndarray, np.ndarray]:
    e = _Entries(table, _ENTRY)
    e.take(np.lexsort((mix(e.key.view(np.uint64)), -e.more, e.hash)))
    new = np.concatenate(([True], e.hash[1:] != e.hash[:-1])) if len(e.hash) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    return e, column, np.flatnonzero(new)


def _fits(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b).astype(np.int64) >= percent * np.maximum(a, b).astype(np.int64)


def _hubs(key, table: pa.Table, percent: int) -> pa.Table:
    """Partial counts of each row with one other row of each column: its most connected one, in an order common to all columns."""
    e, column, start = _columns(table)
    if not len(column):
        return _PAIRS.empty_table()
    hub = start[column]
    good = (e.key != e.key[hub]) & _fits(e.size, e.size[hub], percent) & (e.extra["label"] != e.extra["label"][hub])
    return _pairs(e.key[good], e.key[hub][good])


def _across(key, table: pa.Table, percent: int) -> pa.Table:
    """Pairs of rows of different components that share a column and whose sizes fit."""
    e, column, start = _columns(table)
    if not len(column):
        return _PAIRS.empty_table()
    # Columns within one component have nothing left to join.
    low, high = np.minimum.reduceat(e.extra["label"], start), np.maximum.reduceat(e.extra["label"], start)
    e.take((low != high)[column])
    if not len(e.key):
        return _PAIRS.empty_table()
    # By column, then size: partners of a row stand directly after it, up to the largest size that fits.
    e.take(np.lexsort((e.key, e.size, e.hash)))
    column = np.cumsum(np.concatenate(([0], e.hash[1:] != e.hash[:-1]))).astype(np.int64)
    label, left = e.extra["label"].copy(), e.extra["left"].astype(np.int64)
    wide = np.int64(1) << 32
    place = column * wide + e.size
    last = np.searchsorted(place, column * wide + np.minimum(100 * e.size.astype(np.int64) // percent, wide - 1), "right")
    count = last - np.arange(len(e.key)) - 1
    out_a, out_b = [], []
    ends = np.cumsum(count)
    a = 0
    while a < len(count):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, "right")), a + 1)
        i = np.repeat(np.arange(a, b), count[a:b])
        j = np.arange(len(i)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b]) + i + 1
        bound = percent * (e.size[i].astype(np.int64) + e.size[j])
        good = (label[i] != label[j]) & ((100 + percent) * np.minimum(left[i], left[j]) >= bound)
        x, y = e.key[i[good]], e.key[j[good]]
        pair = np.unique(np.column_stack((np.minimum(x, y), np.maximum(x, y))), axis=0)
        out_a.append(pair[:, 0])
        out_b.append(pair[:, 1])
        a = b
    return _pairs(np.concatenate(out_a), np.concatenate(out_b))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose overlap reaches percent of the union; overlaps are counted over all shared columns."""
    left = sets.select(F.col("key").alias("a"), F.col("size").alias("size_a"), F.col("hashes").alias("hashes_a"))
    right = sets.select(F.col("key").alias("b"), F.col("size").alias("size_b"), F.col("hashes").alias("hashes_b"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "size_a", "size_b", "hashes_a", "hashes_b")

    def run(batches):
        for batch in batches:
            keep = []
            for m, n, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                both = np.sort(np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))))
                overlap = int((both[1:] == both[:-1]).sum())
                keep.append(100 * overlap >= percent * (m + n - overlap))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(run, "a long, b long")


def components(links: DataFrame, label: str) -> DataFrame:
    """(key, label): smallest key reachable by links, for every key that has one. One join and one jump a round."""
    links = materialise(links.select("a", "b"), f"{label}-links")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    state = materialise(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{label}-labels")
    while True:
        near = both.join(state.select(F.col("key").alias("b"), F.col("label").alias("seen")), "b").groupBy(F.col("a").alias("key")).agg(F.min("seen").alias("seen"))
        step = state.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = state.select(F.col("key").alias("label"), F.col("label").alias("further"))
        new = materialise(step.join(jump, "label", "left").select("key", "old", F.least("label", F.coalesce("further", "label")).alias("label")), f"{label}-labels")
        state = new.select("key", "label")
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return state


def _incidence_rows(docs: DataFrame, blocks: int, n: int, percent: int, text: str) -> tuple[DataFrame, DataFrame]:
    """Packed columns with the documents of each row (kind 0), and the rows that could reach a size bound."""
    packed = incidence(docs, blocks, n, text).groupBy("block").applyInArrow(lambda k, t: _frequent(k, t, blocks, percent), PACKED)
    packed = materialise(packed, "ngram-columns")
    sets = packed.where("kind = 1").groupBy("block").applyInArrow(lambda k, t: _rows(k, t, percent), SETS)
    return packed, materialise(sets, "ngram-rows")


def _members(packed: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key) of every document: its row of the matrix."""

    def rows(batches):
        for batch in batches:
            for k, s, d in zip(*(batch.column(c).to_pylist() for c in ("keys", "sizes", "more"))):
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(np.frombuffer(s, np.int32), pa.int64()), pa.array(np.frombuffer(k, np.int64))], names=["doc_id", "n_shingles", "key"])

    return packed.where("kind = 0").mapInArrow(rows, "doc_id long, n_shingles long, key long")


def _component_links(sets: DataFrame, blocks: int, percent: int) -> DataFrame:
    """(key, label): components of the rows, from enough verified pairs to join them."""
    alone = sets.withColumn("label", F.col("key"))
    near = first_columns(alone, blocks).groupBy("block").applyInArrow(lambda k, t: _hubs(k, t, percent), "a long, b long, met int")
    near = near.groupBy("a", "b").agg(F.sum("met").alias("met")).groupBy("a").agg(F.max_by("b", F.struct("met", "b")).alias("b"))
    links = materialise(linked(near, sets, percent), "ngram-links")
    labels = components(links, "ngram-first")

    named = sets.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    rest = first_columns(named, blocks).groupBy("block").applyInArrow(lambda k, t: _across(k, t, percent), "a long, b long, met int")
    more = materialise(linked(rest.select("a", "b").distinct(), sets, percent), "ngram-links")
    if not more.isEmpty():
        labels = components(links.union(more), "ngram-all")
    return labels


def _with_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    some = members.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    some = some.join(labels, "key", "left").select("key", "least", F.coalesce("label", "key").alias("label"))
    names = some.groupBy("label").agg(F.min("least").alias("component_id"))
    some = some.join(names, "label").select("key", "component_id")
    return members.join(some, "key", "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def join_components(docs: DataFrame, n: int = 5, percent: int = 75, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: components of documents with Jaccard similarity >= percent / 100."""
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed, sets = _incidence_rows(docs, blocks, n, percent, text)
    return _with_components(_members(packed), _component_links(sets, blocks, percent)).select("doc_id", "n_shingles", "component_id")


def _all_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: every pair of rows whose overlap reaches percent of the union, once."""

    def run(batches):
        for batch in batches:
            for k, size, need, raw in zip(*(c.to_pylist() for c in batch.columns)):
                h = np.frombuffer(raw, np.int64)
                first = h[: len(h) - need + 1]
                m = len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), pa.array(np.full(m, k)), pa.array(np.full(m, size, np.int32)), pa.array((len(h) - np.arange(m)).astype(np.int32))], names=["h", "key", "size", "left"]
                )

    entries = materialise(sets.select("key", "size", "need", "hashes").mapInArrow(run, "h long, key long, size int, left int"), "ngram-first")
    cells = entries.groupBy("h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("h", F.ceil(F.col("rows") / CELL).cast("int").alias("cells"))
    # A row goes to its own cell with every cell of the column; two rows meet where their two cells do.
    dealt = entries.join(cells, "h").withColumn("own", F.pmod(F.xxhash64("key"), F.col("cells")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    dealt = dealt.select("h", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "key", "size", "left")
    x, y = (dealt.select("h", "lo", "hi", *(F.col(c).alias(f"{c}_{s}") for c in ("own", "key", "size", "left"))) for s in "ab")
    size_a, size_b = F.col("size_a").cast("long"), F.col("size_b").cast("long")
    met = x.join(y, ["h", "lo", "hi"]).where(
        (F.col("key_a") < F.col("key_b"))
        & ((F.col("lo") == F.col("hi")) | (F.col("own_a") != F.col("own_b")))
        & (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b))
        & ((100 + percent) * F.least("left_a", "left_b").cast("long") >= percent * (size_a + size_b))
    )
    return linked(met.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct(), sets, percent)


def join_links(docs: DataFrame, n: int = 5, percent: int = 75, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links: (doc_id, n_shingles, key, component_id, n_links) of every row, and (a, b) of all linked pairs of distinct n-gram sets.

    Documents of one ``key`` have one n-gram set and are linked with each other; ``n_links`` counts the other documents that a
    document is linked with, exact copies included.
    """
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed, sets = _incidence_rows(docs, blocks, n, percent, text)
    links = materialise(_all_links(sets, percent), "ngram-all-links")
    members = _with_components(_members(packed), components(links, "ngram-all"))
    copies = members.where("n_shingles > 0").groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    both = links.union(links.select("b", "a")).toDF("key", "other")
    linked_to = both.join(copies.toDF("other", "copies"), "other").groupBy("key").agg(F.sum("copies").alias("linked"))
    counts = copies.join(linked_to, "key", "left").select("key", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = members.join(counts, "key", "left").withColumn("n_links", F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(F.lit(0)))
    return out.select("doc_id", "n_shingles", "key", "component_id", "n_links"), links


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 75, text: str = "text") -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; rows of one id stay or go together, rows without id stay.

    The ids that go are written first, so Spark knows their size when it plans the join: small ones are broadcast, others shuffled.
    """
    gone = join_components(docs, n, percent, text).where(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = materialise(gone, "ngram-gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
