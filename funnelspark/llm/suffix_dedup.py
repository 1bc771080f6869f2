"""Removal of byte strings that an earlier document has too, by suffix sorting with hash comparisons.

A string is 50 bytes; it is removed wherever it also starts in a document of smaller id. The steps:

1. *Anchors.* Of the 16-byte grams in a string the one with the smallest hash is its anchor, so equal strings have equal anchors
   at equal places. Anchors (one in some 20 bytes) travel packed by hash block, with the four bytes that tell them apart there; those of
   one text only are dropped. Two grams of one hash only make a context travel for nothing.
2. *Contexts.* A text sends, for each anchor that others have too, the bytes of the strings that belong to it. Equal contexts that a
   task meets are combined before the shuffle: only the smallest document goes on, the others are decided. Anchors of more than
   ``HOT`` texts send their strings one by one, dealt out by the hash of the whole string, so no group holds all their texts.
3. *Suffix sort.* In a hash block the suffixes at the string starts of an anchor are merge-sorted, all anchors of the block at once.
   Two suffixes are compared by the length of their common extension, found by binary search over polynomial prefix hashes;
   neighbours that agree over 50 bytes are verified byte by byte. Where bytes differ although hashes agree, the work at hand is done
   again with the next base of ``bases``. Each class of equal strings keeps its smallest document.
4. Spans go back to the buckets of their texts, are merged there and joined to the documents.

Texts that are equal as a whole (by two 64-bit hashes and their length) take part once, with their smallest id; their later copies
are removed whole. Texts have dense numbers, so what travels names them in a few bytes however many blocks there are: numbers,
documents, hashes and places are written as the bytes in which the values of a row differ. The texts are shuffled once, for the
anchors, the contexts and the result.

Defined results: NULL texts are empty; texts under 50 bytes lose nothing; a row without id neither loses anything nor counts as
earlier; rows of one id do not take from each other.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from funnelspark.llm.ragged import binary, mix, powers, slices, text_bytes
from funnelspark.session import materialise

LENGTH = 50
GRAM = 16
#: Bytes of text whose anchors, and whose contexts, a task packs at a time.
FLUSH = 16 << 20
CONTEXT_FLUSH = 4 << 20
#: Texts from which on an anchor's strings are dealt out one by one.
HOT = 50_000
#: Strings that are sorted at a time (or those of one anchor).
SORTED = 200_000
#: Bytes of text that share a hash block, and texts that share a bucket; each is one task's work. Small inputs get up to ``LEAST_BLOCKS``.
BLOCK_BYTES = 32 << 20
LEAST_BLOCKS = 64
BUCKET_TEXTS = 250_000
#: Odd bases of the polynomial hashes; a further one is taken where hashes agree and bytes do not.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_SPREAD = np.uint64(BASES[0])
#: Of what each text shares the upper bytes of the hashes are sent; others that agree in them make a context travel for nothing.
_TOP = np.uint64(0xFFFFFFFF00000000)


class Collision(ArithmeticError):
    """Two different byte strings share a hash."""


def settled(work, bases):
    """``work(base)`` with the first base under which no two different strings share a hash."""
    for base in bases:
        try:
            return work(base)
        except Collision:
            continue
    raise Collision("different byte strings share their hashes under every base given")


class Prefixes:
    """Polynomial prefix hashes of a byte buffer: the hash of any stretch in a few operations."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]) -> None:
        n = len(data)
        self.sum = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n, np.uint64(base))[:n], dtype=np.uint64)))
        self.back = powers(n + 1, np.uint64(pow(base, -1, 1 << 64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sum[end] - self.sum[start]) * self.back[start]

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sum) - size
        return mix((self.sum[size:] - self.sum[:n]) * self.back[:n]) if n > 0 else np.zeros(0, np.uint64)


def _kept(blocks: int) -> np.uint64:
    """The upper bits of a hash that are used: its block and 32 bits in it, 48 at most."""
    return np.uint64((1 << 64) - (1 << 64 - min(48, 31 + blocks.bit_length())))


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w values in a row."""
    out, span = h, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(h) - w + 1], out[w - span : len(h) - span + 1])


def anchors(column: pa.Array, kept: np.uint64):
    """(row, data, gram names, anchor name of each string start) of each text of at least LENGTH bytes.

    Least hashes are small ones, so a name is the hash times an odd number: names fill all blocks alike.
    """
    data, offsets = text_bytes(column)
    grams = Prefixes(data).grams(GRAM)
    for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b - a >= LENGTH:
            h = grams[a : b - GRAM + 1]
            yield r, data[a:b], h * _SPREAD & kept, _least(h, LENGTH - GRAM + 1) * _SPREAD & kept


def _packed_hashes(h: np.ndarray, size: int = 6) -> bytes:
    return binary(np.ascontiguousarray(h).astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :])


def _hashes(packed: bytes, size: int = 6) -> np.ndarray:
    upper = np.frombuffer(packed, np.uint8).reshape(-1, size)
    eight = np.zeros((len(upper), 8), np.uint8)
    eight[:, 8 - size :] = upper
    return eight.view("<u8").ravel()


_HEAD = struct.Struct("<QBB")
_COUNT = struct.Struct("<I")


def _narrow(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Whole numbers of each stretch (beginning at ``first``) in as many bytes as they need above their least, or as steps where all ascend."""
    v = values.astype(np.uint64)
    size = np.diff(np.append(first, len(v)))
    rest = np.diff(v, prepend=v[:1])
    rest[first] = 0
    steps = bool((rest.view(np.int64) >= 0).all())
    base = v[first] if steps else np.minimum.reduceat(v, first)
    if not steps:
        rest = v - np.repeat(base, size)
    used = int(np.bitwise_or.reduce(rest))
    shift = (used & -used).bit_length() - 1 if used else 0
    rest >>= np.uint64(shift)
    top = np.maximum.reduceat(rest, first)
    width = (top[:, None] >= np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)).sum(1)
    planes = rest.astype("<u8").view(np.uint8).reshape(-1, 8)
    return [
        _HEAD.pack(z, shift, w | steps << 4) + planes[a : a + n, :w].T.tobytes() if w or z else b""
        for a, n, w, z in zip(first.tolist(), size.tolist(), width.tolist(), base.tolist())
    ]


def _wide(packed: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of a stretch that :func:`_narrow` wrote."""
    if not packed:
        return np.zeros(n, np.uint64)
    base, shift, how = _HEAD.unpack_from(packed)
    eight = np.zeros((n, 8), np.uint8)
    eight[:, : how & 15] = np.frombuffer(packed, np.uint8, offset=_HEAD.size).reshape(how & 15, n).T
    v = eight.view("<u8").ravel() << np.uint64(shift)
    return (np.cumsum(v, dtype=np.uint64) if how >> 4 else v) + np.uint64(base)


PACKED = "kind int, block int, keys binary, docs binary, at binary, hashes binary, place binary, ranges binary, bytes binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in ("keys", "docs", "at", "hashes", "place", "ranges", "bytes"))])


def _block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)


def _rows(kind, block, keys, docs, at, hashes, place=None, ranges=None, texts=None) -> pa.RecordBatch | None:
    """One packed row per block; ``texts`` are (start, end) cuts of a byte buffer, in the order of the entries."""
    if not len(block):
        return None
    order = np.lexsort((at, block))
    block, at = block[order], at[order]
    new = np.concatenate(([True], block[1:] != block[:-1]))
    fresh = new | np.concatenate(([True], at[1:] != at[:-1]))
    first, own = np.flatnonzero(new), at[fresh]
    own_first = (np.cumsum(fresh) - 1)[first]
    none = [b""] * len(first)
    cols: list[list] = [[kind] * len(first), block[first].tolist(), _narrow(keys[own], own_first), _narrow(docs[own], own_first), [], _narrow(hashes[order], first), none, none, none]
    begins = fresh & ~new
    if place is not None:
        cols[6], cols[7], cols[8] = _narrow(place[order], first), _narrow(ranges[order, 0] * np.uint64(256) + ranges[order, 1], first), []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(block)]):
        # Whether the next number begins, as one bit each.
        cols[4].append(_COUNT.pack(b - a) + binary(np.packbits(begins[a:b])))
        if place is not None:
            o = order[a:b]
            size = texts[2][o] - texts[1][o]
            flat = np.repeat(texts[1][o] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            cols[8].append(pa.compress(binary(texts[0][flat]), codec="zstd", asbytes=True) if len(flat) else b"")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _SCHEMA.types)], schema=_SCHEMA)


def _gathered(table: pa.Table) -> dict[str, np.ndarray]:
    out: dict[str, list] = {c: [] for c in ("key", "doc", "hash", "place", "range", "bytes")}
    for k, d, a, h, p, r, t in zip(*(table.column(c).to_pylist() for c in _SCHEMA.names[2:])):
        n = _COUNT.unpack_from(a)[0]
        at = np.cumsum(np.unpackbits(np.frombuffer(a, np.uint8, offset=_COUNT.size), count=n), dtype=np.int64)
        owners = int(at[-1]) + 1
        out["key"].append(_wide(k, owners).view(np.int64)[at])
        out["doc"].append(_wide(d, owners).view(np.int64)[at])
        out["hash"].append(_wide(h, n))
        out["place"].append(_wide(p, n).astype(np.int32))
        r = _wide(r, n)
        r = np.column_stack((r >> np.uint64(8), r & np.uint64(255))).astype(np.uint8)
        out["range"].append(r)
        out["bytes"].append(np.frombuffer(pa.decompress(t, int(r[:, 1].sum()) + LENGTH * n, codec="zstd", asbytes=True) if t else b"", np.uint8))
    return {c: np.concatenate(v) for c, v in out.items()}


def anchor_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Distinct anchors of each (n, text), packed by hash block."""

    def run(batches):
        keys: dict[int, int] = {}
        hashes: list[np.ndarray] = []
        held, kept = 0, _kept(blocks)

        def flush():
            nonlocal held
            if hashes:
                own = np.array(list(keys), np.int64)
                h = np.concatenate(hashes)
                order = np.argsort(own)
                yield _rows(1, _block_of(h, blocks), own[order], own * 0, np.repeat(np.argsort(order), [len(x) for x in hashes]), h)
            keys.clear()
            hashes.clear()
            held = 0

        for batch in batches:
            for part in slices(batch, "text"):
                n = part.column("n").to_pylist()
                for r, data, _, low in anchors(part.column("text"), kept):
                    if n[r] not in keys:
                        keys[n[r]] = r
                        hashes.append(np.unique(low))
                        held += len(data)
                if held >= FLUSH:
                    yield from flush()
        yield from flush()

    return docs.select("n", "text").mapInArrow(run, PACKED)


def _shared(key, table: pa.Table, buckets: int, hottest: int) -> pa.Table:
    """Anchors of more than one text, by bucket of texts."""
    e = _gathered(table)
    order = np.argsort(e["hash"], kind="stable")
    h = e["hash"][order]
    same = h[1:] == h[:-1]
    order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    order = order[np.lexsort((e["doc"][order], e["key"][order], e["hash"][order]))]
    h, k, c = e["hash"][order], e["key"][order], e["doc"][order]
    fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (k[1:] != k[:-1]) | (c[1:] != c[:-1]))) if len(h) else np.zeros(0, bool)
    h, k = h[fresh], k[fresh]
    column = np.cumsum(np.concatenate(([0], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    count = np.bincount(column)[column] if len(h) else column
    h, k, hot = h[count > 1], k[count > 1], count[count > 1] > hottest
    own, at = np.unique(k, return_inverse=True)
    ranges = np.column_stack((hot, hot)).astype(np.uint8)
    packed = _rows(1, np.mod(k, buckets).astype(np.int32), own, own * 0, at, h, np.zeros(len(h), np.int32), ranges, (np.zeros(0, np.uint8), at * 0, at * 0))
    return pa.Table.from_batches([packed] if packed else [], _SCHEMA)


def _by_text(key, table: pa.Table, firsts: pa.Table) -> pa.Table:
    """(doc_id, tk, n, sorted shared anchors, those of them that are hot) of a bucket of texts, for the smallest document of each text."""
    e = _gathered(table) if table.num_rows else {"hash": np.zeros(0, np.uint64), "key": np.zeros(0, np.int64), "range": np.zeros((0, 2), np.uint8)}
    order = np.lexsort((e["hash"], e["key"]))
    k, h, hot = e["key"][order], e["hash"][order], e["range"][order, 0] > 0
    doc, tk, n = (firsts.column(c).to_numpy() for c in ("least", "tk", "n"))
    a, b = np.searchsorted(k, n), np.searchsorted(k, n, "right")
    some = np.flatnonzero(a < b)
    shared = [_packed_hashes(np.unique(h[a[i] : b[i]] & _TOP), 4) for i in some]
    hottest = [_packed_hashes(h[a[i] : b[i]][hot[a[i] : b[i]]]) for i in some]
    longs = (pa.array(v[some], pa.int64()) for v in (doc, tk, n))
    return pa.table([*longs, pa.array(shared, pa.binary()), pa.array(hottest, pa.binary())], names=["doc_id", "tk", "n", "shared", "hot"])


def contexts(rows: DataFrame, blocks: int, bases: tuple[int, ...] = BASES) -> DataFrame:
    """Packed contexts of the shared anchors of (doc_id, n, text, shared, hot), and under negative blocks what is decided at once."""

    def combined(keys, docs, at, h, place, ranges, hot, data, start, end):
        def hashed(base):
            return mix(Prefixes(data, base).of(start, end) ^ mix(h + ranges[:, 0] * np.uint64(256) + ranges[:, 1]))

        def leaders(base):
            whole = hashed(base)
            order = np.lexsort((docs[at], whole))
            first = np.maximum.accumulate(np.where(np.concatenate(([True], whole[order][1:] != whole[order][:-1])), np.arange(len(order)), 0))
            lead = order[first]
            _verify(data, start[order], start[lead], (end - start)[order], (end - start)[lead])
            if (h[order] != h[lead]).any() or (ranges[order] != ranges[lead]).any():
                raise Collision
            return order, lead

        order, lead = settled(leaders, bases)
        # Strings of hot anchors are dealt out by the first base in every task, whatever base told them apart here.
        dealt = np.where(hot, hashed(bases[0]), h) if hot.any() else h
        later = docs[at[order]] > docs[at[lead]]
        done, rest = order[later], order[~later]
        if len(done):
            block = np.full(len(done), -1 - int(abs(keys[0]) % blocks), np.int32)
            yield _rows(0, block, keys, docs * 0, at[done], h[done] * np.uint64(0), (place[done] - ranges[done, 0]).astype(np.int32), ranges[done], (data[:0], done * 0, done * 0))
        packed = _rows(1, _block_of(dealt[rest], blocks), keys, docs, at[rest], h[rest], place[rest], ranges[rest], (data, start[rest], end[rest]))
        if packed:
            yield packed

    def run(batches):
        keys, docs, parts, size = [], [], [], 0
        kept = _kept(blocks)

        def flush():
            nonlocal keys, docs, parts, size
            if parts:
                at = np.concatenate([np.full(len(p[0]), i) for i, p in enumerate(parts)])
                base = np.cumsum([0] + [len(p[3]) for p in parts[:-1]])
                h, place, ranges, hot = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2, 4))
                start = np.concatenate([p[1] - p[2][:, 0] + b for p, b in zip(parts, base)])
                # A context of a hot anchor becomes one of each string.
                times = np.where(hot, ranges[:, 1].astype(np.int64) + 1, 1)
                one = np.repeat(np.arange(len(h)), times)
                step = np.arange(len(one)) - np.repeat(np.cumsum(times) - times, times)
                at, h, place, start, hot = at[one], h[one], place[one], start[one] + step, hot[one]
                ranges = np.column_stack((ranges[one, 0] - step, np.where(hot, 0, ranges[one, 1]))).astype(np.uint8)
                end = start + ranges[:, 1] + LENGTH
                yield from combined(np.array(keys, np.int64), np.array(docs, np.int64), at, h, place, ranges, hot, np.concatenate([p[3] for p in parts]), start, end)
            keys, docs, parts, size = [], [], [], 0

        for batch in batches:
            for part in slices(batch, "text"):
                n, ids, shared, hot = (part.column(c).to_pylist() for c in ("n", "doc_id", "shared", "hot"))
                for r, data, h, low in anchors(part.column("text"), kept):
                    some, hottest = _hashes(shared[r], 4), _hashes(hot[r])
                    upper = low & _TOP
                    found = np.minimum(np.searchsorted(some, upper), len(some) - 1)
                    start = np.flatnonzero(some[found] == upper)
                    if not len(start):
                        continue
                    # Strings whose anchor is one and the same place: the first place from the start with the least hash.
                    places = np.flatnonzero(np.isin(h & _TOP, some))
                    nxt = np.searchsorted(places, start)
                    while True:
                        wrong = h[places[nxt]] != low[start]
                        if not wrong.any():
                            break
                        nxt[wrong] += 1
                    place = places[nxt]
                    cut = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1))))
                    last = np.append(cut[1:], len(start)) - 1
                    p = place[cut]
                    # From the first start to the anchor, and to the last start; both are under LENGTH.
                    ranges = np.column_stack((p - start[cut], start[last] - start[cut])).astype(np.uint8)
                    parts.append((h[p], p.astype(np.int32), ranges, data, np.isin(h[p], hottest)))
                    keys.append(n[r])
                    docs.append(ids[r])
                    size += len(data)
                if size >= CONTEXT_FLUSH:
                    yield from flush()
        yield from flush()

    return rows.select("doc_id", "n", "text", "shared", "hot").mapInArrow(run, PACKED)


def _extension(prefix: Prefixes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common bytes of suffixes a and b, up to LENGTH, by binary search over prefix hashes where the whole differs."""
    out = np.full(len(a), LENGTH, np.int64)
    rest = np.flatnonzero(prefix.of(a, a + LENGTH) != prefix.of(b, b + LENGTH))
    a, b = a[rest], b[rest]
    sum_a, sum_b, back_a, back_b = prefix.sum[a], prefix.sum[b], prefix.back[a], prefix.back[b]
    low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH - 1, np.int64)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = (prefix.sum[a + mid] - sum_a) * back_a == (prefix.sum[b + mid] - sum_b) * back_b
        low = np.where(same, mid, low)
        high = np.where(same, high, mid - 1)
    out[rest] = low
    return out


def _before(data: np.ndarray, prefix: Prefixes, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
    """Whether suffix a sorts before suffix b (or equals it, if ``ties``)."""
    same = _extension(prefix, a, b)
    i = np.minimum(same, LENGTH - 1)
    return np.where(same == LENGTH, ties, data[a + i] < data[b + i])


def sort_suffixes(data: np.ndarray, prefix: Prefixes, suffix: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes (compared over LENGTH bytes) within ascending groups: bottom-up mergesort of all groups at once.

    The first eight bytes, as one number, decide where they differ.
    """
    order = np.arange(len(suffix))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    head = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))[suffix].astype(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, len(group)))
    begin, count = np.repeat(first, size), np.repeat(size, size)
    run = 1
    while run < size.max(initial=0):
        live = np.flatnonzero(count > run)
        place = live - begin[live]
        mine = place // run
        other = (mine ^ 1) * run
        low = np.minimum(other, count[live]) + begin[live]
        start, high = low, np.minimum(other + run, count[live]) + begin[live]
        # Rank in the sister run; of equal suffixes those of the left run come first.
        right = mine % 2 == 1
        x, head_x = suffix[order[live]], head[order[live]]
        high = high.copy()
        low = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            other_head, own_head = head[order[mid]], head_x[open_]
            r = right[open_]
            left_first = other_head < own_head
            alike = other_head == own_head
            for ties in (True, False):
                like = np.flatnonzero(alike & (r == ties))
                left_first[like] = _before(data, prefix, suffix[order[mid[like]]], x[open_[like]], ties)
            low[open_] = np.where(left_first, mid + 1, low[open_])
            high[open_] = np.where(left_first, high[open_], mid)
        target = begin[live] + (mine // 2) * 2 * run + place % run + (low - start)
        new = order.copy()
        new[target] = order[live]
        order = new
        run *= 2
    return order


def _spans(key, table: pa.Table, buckets: int, most: int, bases: tuple[int, ...] = BASES) -> pa.Table:
    """Removed bytes of each text, packed by its bucket, from the strings of one block of anchors, a bounded number at a time."""
    e = _gathered(table)
    start = e["place"].astype(np.int64)
    if key[0].as_py() < 0:
        return _packed_spans(_removed(e["key"], start, start + e["range"][:, 1] + LENGTH), buckets)
    size = e["range"][:, 1].astype(np.int64) + LENGTH
    begin = np.cumsum(size) - size
    order = np.argsort(e["hash"], kind="stable")
    h = e["hash"][order]
    part = np.cumsum(size[order] - LENGTH + 1) // most
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    cut = first[np.concatenate(([True], part[first][1:] != part[first][:-1]))]
    out = []
    for a, b in zip(cut, np.append(cut[1:], len(h))):
        o = order[a:b]
        flat = np.repeat(begin[o] - np.cumsum(size[o]) + size[o], size[o]) + np.arange(int(size[o].sum()))
        some = {c: v[flat] if c == "bytes" else v[o] for c, v in e.items()}
        out.append(settled(lambda base: _sorted_spans(some, base), bases))
    return _packed_spans(pa.concat_tables(out), buckets)


def _removed(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table({"key": pa.array(key, pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _packed_spans(spans: pa.Table, buckets: int) -> pa.Table:
    """Spans (under twice LENGTH bytes each) by bucket of texts: where they begin, and their size as the range."""
    key, a, b = (spans.column(c).to_numpy() for c in ("key", "a", "b"))
    own, at = np.unique(key, return_inverse=True)
    ranges = np.column_stack((at * 0, b - a)).astype(np.uint8)
    packed = _rows(2, np.mod(key, buckets).astype(np.int32), own, own * 0, at, np.zeros(len(key), np.uint64), a, ranges, (np.zeros(0, np.uint8), at * 0, at * 0))
    return pa.Table.from_batches([packed] if packed else [], _SCHEMA)


def _text_spans(key, table: pa.Table, firsts: pa.Table) -> pa.Table:
    """(doc_id, tk, spans): the merged spans of each text of a bucket that loses any, for its smallest document."""
    n, tk, doc = (firsts.column(c).to_numpy() for c in ("n", "tk", "least"))
    if table.num_rows and len(n):
        e = _gathered(table)
        # Texts of one document whose first hash agrees are met by both, so they are one.
        by = np.lexsort((doc, tk))
        one = np.cumsum(np.concatenate(([True], (tk[by][1:] != tk[by][:-1]) | (doc[by][1:] != doc[by][:-1])))) - 1
        to = np.argsort(n)
        text = np.empty(len(n), np.int64)
        text[by] = one
        text = text[to][np.searchsorted(n[to], e["key"])]
        order = np.lexsort((e["place"], text))
        text, a = text[order], e["place"][order].astype(np.int64)
        b = a + e["range"][order, 1]
        # What ends last so far: texts are told apart by a distance that no place reaches.
        far = text * (int(b.max()) + 2)
        end = np.maximum.accumulate(b + far)
        new = np.concatenate(([True], (a + far)[1:] > end[:-1]))
        first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(a)) - 1
        owner, whole = np.unique(text[first], return_index=True)
        spans = pa.StructArray.from_arrays([pa.array(a[first], pa.int64()), pa.array((end - far)[last], pa.int64())], names=["a", "b"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(whole, len(first)), pa.int32()), spans)
        row = by[np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1])))][owner]
    else:
        row, lists = np.zeros(0, np.int64), pa.array([], pa.list_(pa.struct({"a": pa.int64(), "b": pa.int64()})))
    return pa.table({"doc_id": pa.array(doc[row], pa.int64()), "tk": pa.array(tk[row], pa.int64()), "spans": lists})


def _sorted_spans(e: dict[str, np.ndarray], base: int) -> pa.Table:
    n = len(e["hash"])
    width = e["range"][:, 1].astype(np.int64)
    size = width + LENGTH
    begin = np.cumsum(size) - size
    data = e["bytes"]
    prefix = Prefixes(data, base)
    whole = mix(prefix.of(begin, begin + size) + e["range"][:, 0] * np.uint64(256) + e["range"][:, 1])
    order = np.lexsort((e["doc"], whole, e["hash"]))
    h, w = e["hash"][order], whole[order]
    new_anchor = np.concatenate(([True], h[1:] != h[:-1]))
    new = new_anchor | np.concatenate(([True], w[1:] != w[:-1]))
    # One context stands for all equal ones, with its smallest document (they come in that order).
    context = np.cumsum(new) - 1
    lead = order[new]
    anchor = (np.cumsum(new_anchor) - 1)[new]
    # Equal contexts are verified against their first, byte by byte.
    _verify(data, begin[order], begin[lead][context], size[order], size[lead][context])
    least = e["doc"][lead]
    # All strings of all distinct contexts; strings can only be equal at one distance from one anchor.
    owner = np.repeat(np.arange(len(lead)), width[lead] + 1)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(width[lead] + 1) - width[lead] - 1, width[lead] + 1)
    suffix = begin[lead][owner] + step
    group = anchor[owner] * 64 + e["range"][lead, 0][owner].astype(np.int64) - step
    by = np.argsort(group, kind="stable")
    owner, step, suffix, group = owner[by], step[by], suffix[by], group[by]
    by = sort_suffixes(data, prefix, suffix, group)
    owner, step, suffix, group = owner[by], step[by], suffix[by], group[by]
    same = np.zeros(len(suffix), bool)
    if len(suffix):
        pairs = np.flatnonzero(group[1:] == group[:-1])
        equal = pairs[prefix.of(suffix[pairs], suffix[pairs] + LENGTH) == prefix.of(suffix[pairs + 1], suffix[pairs + 1] + LENGTH)]
        _verify(data, suffix[equal], suffix[equal + 1], np.full(len(equal), LENGTH), np.full(len(equal), LENGTH))
        same[equal + 1] = True
    kind = np.cumsum(~same) - 1
    first = np.full(kind[-1] + 1 if len(kind) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, kind, least[owner])
    back = np.argsort(owner * 64 + step, kind="stable")  # again by context, then by start
    smallest = first[kind][back]
    at = np.concatenate(([0], np.cumsum(width[lead] + 1)))
    # Each row of the block looks at the strings of its context.
    row = np.repeat(np.arange(n), width[order] + 1)
    step = np.arange(len(row)) - np.repeat(np.cumsum(width[order] + 1) - width[order] - 1, width[order] + 1)
    hit = smallest[at[context[row]] + step] < e["doc"][order][row]
    row, step = row[hit], step[hit]
    start = e["place"][order][row].astype(np.int64) - e["range"][order, 0][row] + step
    cut = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))) if len(row) else np.zeros(0, bool)
    last = np.flatnonzero(np.append(cut[1:], True)) if len(row) else row
    rows = order[row[cut]]
    return _removed(e["key"][rows], start[cut], start[last] + LENGTH)


def _verify(data: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
    """Stretches that hashes call equal must be equal."""
    move = np.flatnonzero(a != b)
    for k in range(0, len(move), 1 << 14):
        m = move[k : k + (1 << 14)]
        size = size_a[m]
        flat = np.repeat(a[m] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        shift = np.repeat(b[m] - a[m], size)
        if (size != size_b[m]).any() or (data[flat] != data[flat + shift]).any():
            raise Collision


def find(docs: DataFrame, text: str = "text", hot: int = HOT, most: int = SORTED, bases: tuple[int, ...] = BASES) -> DataFrame:
    """(doc_id, text, copy, spans) of every row: whether an earlier document has the whole text, and the removed stretches, merged."""
    # Ids that are longs already stay the column they are: with an alias the two readers of the text shuffle would not be seen as one.
    doc_id = F.col("doc_id") if dict(docs.dtypes).get("doc_id") == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    raw = docs.select(doc_id, F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = raw.where(F.col("doc_id").isNotNull()).withColumn("tk", F.xxhash64("text", F.octet_length("text")))
    check = F.xxhash64(F.lit(1), "text").alias("check")
    ids = materialise(keyed.where(F.octet_length("text") >= LENGTH).select("doc_id", "tk", check, F.octet_length("text").alias("size")), "dedup-ids")
    total = ids.agg(F.count("*").alias("texts"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks, buckets = max(min(parts, LEAST_BLOCKS), total["bytes"] // BLOCK_BYTES), max(parts, total["texts"] // BUCKET_TEXTS)
    least = ids.groupBy("tk", "check").agg(F.min("doc_id").alias("least")).withColumn("block", F.pmod("tk", F.lit(buckets)).cast("int"))
    number = F.row_number().over(Window.partitionBy("block").orderBy("tk", "check")).cast("long") * buckets + F.col("block")
    firsts = materialise(least.withColumn("n", number), "dedup-firsts")
    copies = ids.join(firsts.select("tk", "check", "least"), ["tk", "check"]).where(F.col("doc_id") > F.col("least")).select("doc_id", "tk", F.lit(True).alias("copy")).distinct()

    # All joins to the texts have the same keys and read the same columns, so one shuffle serves them.
    numbered = keyed.join(firsts.select(F.col("least").alias("doc_id"), "tk", "n"), ["doc_id", "tk"])
    shared = anchor_blocks(numbered, blocks).groupBy("block").applyInArrow(lambda k, t: _shared(k, t, buckets, hot), PACKED)
    own = firsts.select("block", "n", "tk", "least").groupBy("block")
    shared = shared.groupBy("block").cogroup(own).applyInArrow(lambda k, t, o: _by_text(k, t, o), "doc_id long, tk long, n long, shared binary, hot binary")
    found = contexts(keyed.join(shared, ["doc_id", "tk"]), blocks, bases).groupBy("block").applyInArrow(lambda k, t: _spans(k, t, buckets, most, bases), PACKED)
    spans = found.groupBy("block").cogroup(own).applyInArrow(lambda k, t, o: _text_spans(k, t, o), "doc_id long, tk long, spans array<struct<a:bigint,b:bigint>>")
    out = keyed.join(spans, ["doc_id", "tk"], "left").join(copies, ["doc_id", "tk"], "left")
    out = out.select("doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")).alias("spans"))
    return out.unionByName(raw.where(F.col("doc_id").isNull()).select("doc_id", "text", F.lit(False).alias("copy"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("spans")))


def dedup(docs: DataFrame, text: str = "text", hot: int = HOT, most: int = SORTED, bases: tuple[int, ...] = BASES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left; cutting may split a character)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                out: list[list] = [[], [], [], []]
                copy, spans = part.column("copy").to_pylist(), part.column("spans").to_pylist()
                for a, b, whole, own in zip(offsets[:-1].tolist(), offsets[1:].tolist(), copy, spans):
                    raw = data[a:b]
                    if whole:
                        own = [{"a": 0, "b": b - a}]
                    gone = np.zeros(b - a + 1, np.int32)
                    np.add.at(gone, [s["a"] for s in own], 1)
                    np.add.at(gone, [s["b"] for s in own], -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    kept = raw[~gone].tobytes()
                    values = int(gone.sum()), int((gone & ~np.concatenate(([False], gone[:-1]))).sum()), hashlib.sha256(kept).hexdigest(), kept
                    for c, v in zip(out, values):
                        c.append(v)
                types = (pa.int64(), pa.int64(), pa.string(), pa.binary())
                arrays = [part.column("doc_id"), pa.array(np.diff(offsets)), *(pa.array(v, t) for v, t in zip(out, types))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return find(docs, text, hot, most, bases).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
