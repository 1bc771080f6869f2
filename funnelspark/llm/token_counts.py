"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of ragged arrays.

Pre-tokens of a slice are held end to end in one array of symbol numbers. In each step every sequence applies its own
lowest-ranked pair, at all places from left to right, all sequences at once; sequences without a pair leave. What
survives is the count.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; the vocabulary's special strings inside a text count as
one token each, as the library's default does; extra columns of the input are not read.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from funnelspark.llm.frames import append

#: Distinct parts between single spaces whose counts a task remembers; beyond that it starts anew.
CACHE = 300_000
#: Parts longer than this many characters are not remembered (they rarely repeat).
CACHED_BYTES = 64
# The pre-token pattern of the vocabulary (fixed value); white space is Unicode's property.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_NONE = np.int32(2**31 - 1)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code point from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return out


class Merges:
    """Pair ranks of a vocabulary file as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = _byte_letters()
        self.byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        self.ranks = np.append(self.rank, _NONE).astype(np.int32)
        self.first = np.empty((256, 256), np.int32)
        both = np.repeat(self.byte, 256), np.tile(self.byte, 256)
        flat = self.first.reshape(-1)
        self._look(np.column_stack(both).reshape(-1), every := np.empty(2 << 16, np.int32), np.arange(0, 2 << 16, 2))
        flat[:] = every[::2]
        self.special = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]

    def _look(self, symbol: np.ndarray, pair: np.ndarray, at: np.ndarray) -> None:
        """Sets ``pair`` at the given places from the symbols there and after them."""
        key = symbol[at] * self.width + symbol[at + 1]
        order = np.argsort(key, kind="stable")
        found = np.empty(len(key), np.int64)
        found[order] = np.searchsorted(self.key, key[order])
        found = np.minimum(found, len(self.key) - 1)
        pair[at] = np.where(self.key[found] == key, found, len(self.key))

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string."""
        out = np.zeros(len(tokens), np.int64)
        length = np.array([len(t) for t in tokens], np.int64)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        symbol = self.byte[raw]
        live = np.flatnonzero(length)
        length = length[live]
        start = np.cumsum(length) - length
        # place of the pair (symbol, next symbol) in the sorted pairs, or the number of pairs for none
        pair = np.full(len(symbol), len(self.key), np.int32)
        pair[:-1] = self.first[raw[:-1], raw[1:]]
        pair[start + length - 1] = len(self.key)
        while len(live):
            rank = self.ranks[pair]
            least = np.minimum.reduceat(rank, start)
            done = least == _NONE
            if done.any():
                out[live[done]] = length[done]
                stay = np.repeat(~done, length)
                symbol, pair, rank = symbol[stay], pair[stay], rank[stay]
                live, length, least = live[~done], length[~done], least[~done]
                if not len(live):
                    break
            hit = rank == np.repeat(least, length)
            at = np.flatnonzero(hit)
            # A pair of equal symbols overlaps itself: of a run of such places every second one merges.
            close = np.concatenate(([False], np.diff(at) == 1))
            if close.any():
                count = np.arange(len(at))
                run = np.maximum.accumulate(np.where(close, 0, count))
                at = at[(count - run) % 2 == 0]
            symbol[at] = self.made[pair[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            owner = np.searchsorted(np.cumsum(length), at, "right")
            length = length - np.bincount(owner, minlength=len(length))
            # The last symbol of a sequence has no pair, whatever merged into it.
            start = np.cumsum(length) - length
            new = np.cumsum(stay)[at] - 1
            symbol, pair = symbol[stay], pair[stay]
            ends = np.zeros(len(symbol) + 1, bool)
            ends[start] = True
            ends[len(symbol)] = True
            changed = np.zeros(len(symbol), bool)
            changed[new[~ends[new + 1]]] = True
            changed[new[~ends[new]] - 1] = True
            pair[new[ends[new + 1]]] = len(self.key)
            self._look(symbol, pair, np.flatnonzero(changed))
        return out


@lru_cache(maxsize=2)
def _merges(path: str) -> Merges:
    return Merges(path)


def counter(path: str):
    """A function from a text column to (bytes, tokens) of each row."""
    merges = _merges(path)
    find = regex.compile(_PATTERN).findall
    split = regex.compile("|".join(regex.escape(s) for s in sorted(merges.special, key=len, reverse=True))).split if merges.special else None
    known: dict[str, int] = {}

    def each(strings: list[str]) -> list[int]:
        """Tokens of each string by itself; all their distinct pre-tokens are merged together."""
        found = [find(p) for p in strings]
        distinct = list({t for f in found for t in f})
        made = dict(zip(distinct, merges.counts([t.encode() for t in distinct]).tolist()))
        return [sum(map(made.__getitem__, f)) for f in found]

    def count(column: pa.Array) -> list:
        sizes = pc.fill_null(pc.binary_length(column), 0)
        if len(known) > CACHE:
            known.clear()
        tokens = np.zeros(len(column), np.int64)
        rows: list[tuple[int, list[str], str]] = []
        for i, text in enumerate(column.to_pylist()):
            pieces = split(text) if split and text else [text or ""]
            tokens[i] = len(pieces) - 1
            rows += [(i, piece.split(" "), piece) for piece in pieces]
        # A single space between other characters always begins a pre-token, so what stands between such spaces can be
        # counted by itself, with the space before it. Parts at other white space are not known, and their rows go whole.
        fresh = set().union(*(parts[1:] for _, parts, _ in rows)).difference(known)
        regular = [p for p in fresh if p and not p[0].isspace() and not p[-1].isspace()]
        known.update(zip(regular, each([" " + p for p in regular])))
        rest = []
        for i, parts, piece in rows:
            try:
                if parts[0][-1:].isspace():
                    raise KeyError
                tokens[i] += sum(map(known.__getitem__, parts[1:]))
                rest.append((i, parts[0]))
            except KeyError:
                rest.append((i, piece))
        np.add.at(tokens, [i for i, _ in rest], each([p for _, p in rest]))
        for p in regular:
            if len(p) > CACHED_BYTES:
                del known[p]
        return [pc.cast(sizes, pa.int64()), tokens]

    return count


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a byte-level BPE file present on every worker (an installed package's data file).
    No shuffle: rows stay where the scan put them.
    """
    out = append(docs, text, [("n_bytes", T.LongType()), ("n_tokens", T.LongType())], lambda: counter(vocabulary))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
