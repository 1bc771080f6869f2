"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a run of documents of about ``SHARD_BYTES``. Its words become symbols of the benchmark's vocabulary; any other word ends a run, and
runs shorter than the shortest test phrase cannot hold one and are left out. The shard's suffix array gives a Burrows-Wheeler
transform, kept as a wavelet matrix with rank counts. All test phrases step backwards through it at once; occurrences are
located by walking to sampled suffix positions, mapped to document words and merged to removal spans.

The benchmark is taken in blocks of at most ``BLOCK_WORDS`` words, each a bounded broadcast of its own. One block is met in one
scan of the documents, without a shuffle. Several blocks are met one after another: a pass writes the texts with hits, its broadcast
is destroyed before the next block is read, and the hits of all passes are joined back by the texts' SHA-256. So neither the driver
nor a task ever holds more than two blocks of items and one broadcast, however large the benchmark is. Words meet by a 64-bit hash: a false hit needs as many colliding words in a row as a
phrase has.

Defined results: NULL texts have no words; an item without words or without an id has no window; items that repeat an id count
once; empty tables give empty results or no hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from funnelspark.operators.intervals import null_spread
from funnelspark.session import materialise
from funnelspark.llm.ragged import ALNUM, LOWER, concat_rows, slices, text_bytes, word_hashes, word_spans

#: Words of a test phrase; shorter items are one phrase.
WINDOW = 10
#: Benchmark words of one block (and so of one broadcast, some 40 MB).
BLOCK_WORDS = 1_000_000
#: Text of one shard (or one longer text).
SHARD_BYTES = 8 << 20
#: Every so many text positions keep their place in the suffix array.
SAMPLE = 8


class Phrases:
    """Test phrases of one block as symbol sequences."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        data, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
        start, end, row = word_spans(data, offsets, ALNUM[data])
        h = word_hashes(LOWER[data], start, end, ALNUM[data])
        self.vocabulary = np.unique(h)
        symbol = np.searchsorted(self.vocabulary, h) + 1
        count = np.bincount(row, minlength=len(items))
        first = np.concatenate(([0], np.cumsum(count)))[:-1]
        size = np.minimum(count, WINDOW)
        windows = np.where(count > 0, np.maximum(count - WINDOW + 1, 1), 0)
        owner = np.repeat(np.arange(len(items)), windows)
        at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.size, self.item = size[owner], owner
        self.symbols = np.zeros((len(owner), WINDOW), np.int64)
        for j in range(WINDOW):
            some = self.size > j
            self.symbols[some, j] = symbol[at[some] + j]
        self.ids = [i for i, _ in items]
        self.least = int(self.size.min()) if len(owner) else 0


class Index:
    """FM-index of a symbol sequence whose only 0 is its end, with sampled suffix positions."""

    def __init__(self, text: np.ndarray, sigma: int) -> None:
        n = len(text)
        rank, k = text.astype(np.int64), 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - k] = rank[k:] + 1 if k < n else 0
            key = rank * (n + sigma + 2) + after
            suffix = np.argsort(key, kind="stable")
            key = key[suffix]
            order = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            rank = np.empty(n, np.int64)
            rank[suffix] = order
            if order[-1] == n - 1 or k >= n:
                break
            k *= 2
        self.last = text[suffix - 1]
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma + 1))))
        self.levels, seq = [], self.last
        for bit in range(max(int(sigma).bit_length(), 1) - 1, -1, -1):
            one = (seq >> bit & 1).astype(bool)
            self.levels.append((bit, np.concatenate(([0], np.cumsum(one))).astype(np.int32), int(n - one.sum())))
            seq = np.concatenate((seq[~one], seq[one]))
        sampled = suffix % SAMPLE == 0
        self.sampled, self.sample_rank, self.samples = sampled, np.cumsum(sampled) - 1, suffix[sampled]
        self.begin = self._down(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))
        self.n = n

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            up = ones[i]
            i = np.where(symbol >> bit & 1, zeros + up, i - up)
        return i

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Rows before the block of ``symbol`` plus its occurrences in the first ``i`` places of the transform."""
        return self.less[symbol] + self._down(symbol, i) - self.begin[symbol]

    def search(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array range of every phrase, all stepping backwards together."""
        live = np.arange(len(size))
        low, high = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64)
        for j in range(symbols.shape[1]):
            live = live[(size[live] > j) & (low[live] < high[live])]
            if not len(live):
                break
            c = symbols[live, size[live] - 1 - j]
            low[live], high[live] = self.step(c, low[live]), self.step(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back until a sampled position is met."""
        out, live, at, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(live):
            known = self.sampled[at]
            out[live[known]] = self.samples[self.sample_rank[at[known]]] + steps
            live, at = live[~known], at[~known]
            at = self.step(self.last[at], at)
            steps += 1
        return out


def occurrences(symbol: np.ndarray, row: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place) of every occurrence of a phrase inside a document; ``symbol`` is 0 for other words, ``row`` ascends."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not phrases.least or not len(symbol):
        return none
    known = symbol > 0
    run = np.cumsum(np.concatenate(([True], (row[1:] != row[:-1]) | (known[1:] != known[:-1]))))
    keep = known & (np.bincount(run)[run] >= phrases.least)
    place = np.flatnonzero(keep)
    if not len(place):
        return none
    # Runs end to end with 1 between them; words are 2 and above, and one 0, the least symbol, ends the text.
    new = np.concatenate(([False], run[place][1:] != run[place][:-1]))
    at = np.arange(len(place)) + np.cumsum(new)
    text = np.ones(at[-1] + 2, np.int64)
    text[-1] = 0
    text[at] = symbol[place] + 1
    back = np.zeros(len(text), np.int64)
    back[at] = place
    index = Index(text, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.symbols + 1, phrases.size)
    found = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(found)), found)
    rows = np.repeat(low, found) + np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
    return which, back[index.locate(rows)]


def _union(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of places covered by the intervals [a, b)."""
    if not len(a):
        return a, b
    depth = np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1))
    covered = np.concatenate(([False], depth[:n] > 0, [False]))
    edge = np.flatnonzero(covered[1:] != covered[:-1])
    return edge[::2], edge[1::2]


def scan(column: pa.Array, parts: Iterator[pa.Array], phrases: Phrases) -> tuple[list, list, list]:
    """Per row: number of words, spans as (first word, word after, first byte, byte after), and item ids."""
    symbols, rows, starts, ends, before, origin = [], [], [], [], 0, []
    for part in parts:
        data, offsets = text_bytes(part)
        start, end, row = word_spans(data, offsets, ALNUM[data])
        h = word_hashes(LOWER[data], start, end, ALNUM[data])
        if len(phrases.vocabulary):
            at = np.minimum(np.searchsorted(phrases.vocabulary, h), len(phrases.vocabulary) - 1)
            symbols.append(np.where(phrases.vocabulary[at] == h, at + 1, 0))
        else:
            symbols.append(np.zeros(len(h), np.int64))
        rows.append(row + before)
        starts.append((start - offsets[row]).astype(np.int64))
        ends.append((end - offsets[row]).astype(np.int64))
        before += len(part)
    n = len(column)
    symbol, row = concat_rows(symbols, np.int64), concat_rows(rows, np.int64)
    start, end = concat_rows(starts, np.int64), concat_rows(ends, np.int64)
    words = np.bincount(row, minlength=n)
    which, place = occurrences(symbol, row, phrases)
    spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
    if len(which):
        first = np.concatenate(([0], np.cumsum(words)))
        # A gap of one place between documents keeps the spans of neighbours apart.
        gap = place + row[place]
        a, b = _union(gap, gap + phrases.size[which], len(row) + n)
        owner = np.searchsorted(first[1:] + np.arange(n), a, "right")
        a, b = a - owner, b - owner
        for r, x, y in zip(owner.tolist(), a.tolist(), b.tolist()):
            spans[r].append((x - int(first[r]), y - int(first[r]), int(start[x]), int(end[y - 1])))
        pair = np.unique(row[place] * np.int64(len(phrases.ids)) + phrases.item[which])
        for r, i in zip((pair // len(phrases.ids)).tolist(), (pair % len(phrases.ids)).tolist()):
            items[r].append(phrases.ids[i])
    return words.tolist(), spans, items


SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "after", "byte", "byte_after")])
_ARROW_SPAN = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "after", "byte", "byte_after")]))


def blocks(bench: DataFrame, item: str = "item_id", text: str = "text", most: int = BLOCK_WORDS) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``most`` words (or one item); the driver holds one block at a time."""
    rows = bench.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        words = len(r["t"]) // 2 + 1
        if block and size + words > most:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += words
    yield block


def find(docs: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged removal spans in words and bytes) and ``items`` (ids, sorted as strings)."""
    added = {"n_words", "spans", "items"}
    out = docs.select(*[docs[c] for c in docs.columns if c.lower() not in added or c == text])
    parts = blocks(bench)
    first, second = next(parts), next(parts, None)
    if second is None:
        found = _meet(out, docs.sparkSession.sparkContext.broadcast(Phrases(first)), text)
    else:
        found = _passes(out, chain((first, second), parts), text)
    return found.withColumn("items", F.array_sort(F.array_distinct("items")))


def _meet(docs: DataFrame, phrases: Broadcast, text: str, hits_only: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` and ``items`` of one block; only the rows with hits if asked for."""
    fields = [f for f in docs.schema.fields if f.name != "n_words"]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            for shard in slices(batch, text, SHARD_BYTES):
                words, spans, items = scan(shard.column(text), (p.column(text) for p in slices(shard, text)), phrases.value)
                spans = [[dict(zip(SPAN.names, s)) for s in row] for row in spans]
                made = [pa.array(words, pa.int64()), pa.array(spans, _ARROW_SPAN), pa.array(items, pa.list_(pa.string()))]
                found = pa.RecordBatch.from_arrays([*(shard.column(c) for c in names), *made], names=schema.names)
                yield found.filter(pa.array([bool(s) for s in spans], pa.bool_())) if hits_only else found

    return docs.mapInArrow(run, schema)


def _passes(docs: DataFrame, parts: Iterable[list[tuple[str, str]]], text: str) -> DataFrame:
    """As ``_meet`` for all ``parts``, a pass over the texts each.

    Hits depend on the text alone, so each text with hits is kept once a pass, under its SHA-256; equal texts get the same hits.
    """
    key = F.sha2(F.col(text), 256)
    hits = None
    for block in parts:
        phrases = docs.sparkSession.sparkContext.broadcast(Phrases(block))
        met = _meet(docs.select(text), phrases, text, hits_only=True).select(key.alias("_key"), "spans", "items")
        met = materialise(met.dropDuplicates(["_key"]), "benchmark-hits")
        phrases.destroy()
        hits = met if hits is None else hits.unionByName(met)
    by_text = hits.groupBy("_key").agg(
        _merged(F.array_sort(F.flatten(F.collect_list("spans")))).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    held = docs.select(*[docs[c] for c in docs.columns if c != "n_words"], F.coalesce(key, null_spread(docs).cast("string")).alias("_key"))
    spans = F.coalesce("spans", F.array().cast(T.ArrayType(SPAN))).alias("spans")
    items = F.coalesce("items", F.array().cast("array<string>")).alias("items")
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")), F.lit(0)).cast("long")
    return held.join(by_text, "_key", "left").select(*[c for c in held.columns if c != "_key"], words.alias("n_words"), spans, items)


def _merged(spans):
    """Joins overlapping and adjoining spans of a sorted array."""

    def add(done, s):
        last = F.element_at(done, -1)
        joined = F.struct(last.first.alias("first"), F.greatest(last.after, s.after).alias("after"), last.byte.alias("byte"), F.greatest(last.byte_after, s.byte_after).alias("byte_after"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)).after >= s.first), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast(T.ArrayType(SPAN)), add)


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = find(docs.select("doc_id", text), bench, text)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.after - s.first)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans")


def without_spans(docs: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all columns, the hit words cut out of the texts; a document of which no word is left goes.

    ``n_chars``, where present, follows the new text.
    """
    held = docs.select(F.struct(F.lit(0).alias("_"), *[docs[c] for c in docs.columns if c != text]).alias("_row"), docs[text].alias("_text"))
    found = find(held, bench, "_text")
    raw = F.col("_text").cast("binary")
    edges = F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform("spans", lambda s: F.array(s.byte, s.byte_after))), F.array(F.octet_length("_text").cast("long")))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda i: F.substring(raw, (F.element_at("_edges", (2 * i + 1).cast("int")) + 1).cast("int"), (F.element_at("_edges", (2 * i + 2).cast("int")) - F.element_at("_edges", (2 * i + 1).cast("int"))).cast("int")).cast("string"),
    )
    cut = F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(F.col("_text"))
    left = F.col("n_words") - F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.after - s.first)
    out = found.where((F.size("spans") == 0) | (left > 0)).withColumn("_edges", edges).withColumn("_cut", cut)
    names = {c.lower() for c in docs.columns}
    cols = []
    for f in docs.schema.fields:
        if f.name == text:
            cols.append(F.col("_cut").alias(text))
        elif f.name.lower() == "n_chars" and "n_chars" in names:
            cols.append(F.when(F.size("spans") > 0, F.length("_cut")).otherwise(F.col(f"_row.`{f.name}`")).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"_row.`{f.name}`").alias(f.name))
    return out.select(*cols)
