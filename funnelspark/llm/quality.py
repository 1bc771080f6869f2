"""Document quality by a generalised additive model with pairwise interactions.

Shape features of the whole text are binned; boosting visits the features in turn and adds a shallow tree over the bins of
one feature (later of one pair of features) to that feature's lookup table. A score is the sum of the table cells of a
document's bins, through the logistic function.

Fitting uses at most ``sample`` labelled documents outside the held-out fold (a bound, 20,000 by default) and runs on their
feature rows. Scoring covers every row, without a shuffle.

Defined results: NULL and empty texts score as texts without words; repeated label rows count once; without any label the
score is 0.5; labels outside 0 and 1 are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from funnelspark.llm.frames import append, fold_of, labelled_sample
from funnelspark.llm.ragged import ALNUM, LOWER, NOT_SPACE, text_bytes, word_hashes, word_spans

FEATURES = (
    "words", "word_length", "upper", "symbols", "digits", "distinct", "top_word", "distinct_pairs", "same_as_last", "lines_repeated",
    "line_words", "pipes", "marks", "symbol_ends", "stops", "quotes",
)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = ~ALNUM & NOT_SPACE
for _c in b".,;:-'()":
    _SYMBOL[_c] = False


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the largest count of one value, by row."""
    if not len(row):
        return np.zeros(n), np.zeros(n)
    key = np.sort((row.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    at = (key[first] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, at, size)
    return np.bincount(at, minlength=n).astype(float), top


def features(column: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` per text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    inside = NOT_SPACE[data]
    start, end, row = word_spans(data, offsets, inside)
    h = word_hashes(LOWER[data], start, end, inside)
    words = np.bincount(row, minlength=n).astype(float)
    some = np.maximum(words, 1)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (total[offsets[1:]] - total[offsets[:-1]]) / of

    letters = np.maximum(share(inside, 1.0), 1)
    kinds, top = _distinct(row, h, n)
    pair = np.flatnonzero(row[1:] == row[:-1])
    pairs, _ = _distinct(row[pair], h[pair] * np.uint64(31) + h[pair + 1], n)
    same = np.bincount(row[pair[h[pair] == h[pair + 1]]], minlength=n)
    not_break = data != 10
    ls, le, lrow = word_spans(data, offsets, not_break)
    lines = np.bincount(lrow, minlength=n).astype(float)
    line_kinds, _ = _distinct(lrow, word_hashes(data, ls, le, not_break), n)
    symbol = _SYMBOL[data]
    ends = np.bincount(row[symbol[end - 1]], minlength=n) if len(end) else np.zeros(n)
    short = np.bincount(row[end - start <= 3], minlength=n)
    return np.column_stack([
        np.log1p(words), letters / some, share(_UPPER[data], letters), share(symbol, letters), share(_DIGIT[data], letters),
        kinds / some, top / some, pairs / np.maximum(words - 1, 1), same / some, 1 - line_kinds / np.maximum(lines, 1),
        np.log1p(words / np.maximum(lines, 1)), share(data == 124, letters), share((data == 33) | (data == 63), letters), ends / some,
        short / some, share(data == 34, letters),
    ])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tree(g: np.ndarray, w: np.ndarray, leaves: int, ridge: float = 5.0) -> np.ndarray:
    """Values per bin of a tree with few leaves: the best next cut of bin sums (gradient, weight), greedily."""
    parts, out = [(0, len(g))], np.zeros(len(g))
    gain_of = lambda a, b: a * a / (b + ridge)
    for _ in range(leaves - 1):
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            cg, cw = np.cumsum(g[a:b]), np.cumsum(w[a:b])
            gain = gain_of(cg[:-1], cw[:-1]) + gain_of(cg[-1] - cg[:-1], cw[-1] - cw[:-1]) - gain_of(cg[-1], cw[-1])
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), k, a + int(gain.argmax()) + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (w[a:b].sum() + ridge)
    return out


class Additive:
    """Lookup tables of single features and of pairs, with the cuts of their bins."""

    def __init__(self, cuts, coarse, tables, pairs, base) -> None:
        self.cuts, self.coarse, self.tables, self.pairs, self.base = cuts, coarse, tables, pairs, base

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            z += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (i, j), table in self.pairs.items():
            z += table[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return _sigmoid(z)


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse_bins: int = 8, rounds: int = 60, rate: float = 0.15, pairs: int = 6) -> Additive:
    """Cyclic boosting: single features first, then the pairs whose cells explain most of what is left."""
    d = x.shape[1]
    if not len(y) or y.min() == y.max():
        base = 0.0 if not len(y) else float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return Additive([np.zeros(0)] * d, [np.zeros(0)] * d, [np.zeros(1)] * d, {}, base)
    cut = lambda j, k: np.unique(np.quantile(x[:, j], np.linspace(0, 1, k + 1)[1:-1]))
    cuts, coarse = [cut(j, bins) for j in range(d)], [cut(j, coarse_bins) for j in range(d)]
    at = [np.searchsorted(cuts[j], x[:, j], "right") for j in range(d)]
    low = [np.searchsorted(coarse[j], x[:, j], "right") for j in range(d)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    z = np.full(len(y), base)
    for _ in range(rounds):
        for j in range(d):
            p = _sigmoid(z)
            m = len(tables[j])
            step = rate * _tree(np.bincount(at[j], y - p, m), np.bincount(at[j], p * (1 - p), m), 3)
            tables[j] += step
            z += step[at[j]]
    p, gains = _sigmoid(z), []
    cell = {}
    for i in range(d):
        for j in range(i):
            m, k = len(coarse[i]) + 1, len(coarse[j]) + 1
            cell[i, j] = low[i] * k + low[j]
            g, w = np.bincount(cell[i, j], y - p, m * k), np.bincount(cell[i, j], p * (1 - p), m * k)
            gains.append(((g * g / (w + 5.0)).sum(), (i, j)))
    chosen = {ij: np.zeros((len(coarse[ij[0]]) + 1, len(coarse[ij[1]]) + 1)) for _, ij in sorted(gains, reverse=True)[:pairs]}
    for _ in range(rounds // 3):
        for (i, j), table in chosen.items():
            p = _sigmoid(z)
            shape = table.shape
            g = np.bincount(cell[i, j], y - p, table.size).reshape(shape)
            w = np.bincount(cell[i, j], p * (1 - p), table.size).reshape(shape)
            # Depth two: one cut of the first feature, then each side's own cut of the second.
            side = np.concatenate(([0], np.cumsum(np.diff(_tree(g.sum(1), w.sum(1), 2)) != 0)))
            step = np.vstack([np.zeros(shape[1])] * shape[0])
            for s in np.unique(side):
                step[side == s] = _tree(g[side == s].sum(0), w[side == s].sum(0), 2)
            table += rate * step
            z += rate * step.reshape(-1)[cell[i, j]]
    return Additive(cuts, coarse, tables, chosen, base)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, held: int = 2, sample: int = 20_000) -> Additive:
    """Fits on at most ``sample`` labelled rows outside the held-out fold; their features (128 bytes a row) reach the driver."""
    rows = labelled_sample(docs, labels, label, modulus, held, sample)
    found = append(rows, "text", [("features", T.ArrayType(T.DoubleType()))], lambda: lambda c: [features(c).tolist()])
    got = found.select("doc_id", "label", "features").toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["features"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort((*x.T, got["doc_id"].to_numpy()))
    return fit(x[order], got["label"].to_numpy(float)[order])


def quality(docs: DataFrame, model: Additive, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= ``threshold``)."""
    out = append(docs, text, [("score", T.DoubleType())], lambda: lambda c: [model.score(features(c))])
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(modulus: int, held: int):
    return (fold_of(F.col("doc_id"), modulus) == held).alias("held_out")
