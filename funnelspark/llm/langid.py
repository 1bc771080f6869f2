"""Language identification by nearest centroid: hashed character n-gram TF-IDF vectors, several centroids per language, cosine.

Fitting takes at most ``sample`` texts with a language outside the held-out fold (bounded, 4,000 by default), computes inverse
document frequencies and clusters each language's unit vectors by spherical k-means. Scoring reads every whole text, without a shuffle.

Letters and the marks that belong to them are told by Unicode category; words are runs of both.

Defined results: NULL texts and texts without a letter (symbols, digits, marks alone) are ``und`` with score 0; equal cosines go to the alphabetically first
language; a text further from every centroid than ``reach`` times the training distances is flagged ``rejected`` but keeps its
nearest language; without training rows everything is ``und``.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from funnelspark.llm.frames import append, fold_of
from funnelspark.llm.ragged import LOWER, text_bytes, word_spans

#: Hash cells of the n-gram space (character 1-, 2- and 3-grams with word edges).
CELLS = 1 << 13
#: Texts of one dense table of counts.
STEP = 32


@functools.cache
def _kinds() -> np.ndarray:
    """1 for letters, 2 for marks, 0 for all other code points."""
    return np.array([{"L": 1, "M": 2}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def _kind_of_bytes(data: np.ndarray) -> np.ndarray:
    """Kind of the character that each byte of a UTF-8 text is part of."""
    begin = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(begin, len(data)))
    code = data[begin].astype(np.int32) & np.array([0, 0x7F, 0x1F, 0x0F, 0x07], np.int32)[np.minimum(size, 4)]
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << 6 | data[begin[more] + k] & 0x3F
    return np.repeat(_kinds()[np.minimum(code, 0x10FFFF)], size)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and hash cell of every n-gram of bytes (1 to 4) inside the words of each text; words are padded by an edge mark."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    kind = _kind_of_bytes(data)
    start, end, row = word_spans(data, offsets, kind > 0)
    if len(start):  # a run of marks alone is no word
        word = np.add.reduceat(kind == 1, start, dtype=np.int64) > 0
        start, end, row = start[word], end[word], row[word]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n
    size = end - start + 1
    owner = np.repeat(np.arange(len(start)), size)
    first = np.cumsum(size) - size
    # One edge mark, then the word's bytes; all words end to end.
    at = np.arange(len(owner)) - first[owner]
    flat = np.where(at == 0, 0, LOWER[data[np.minimum(start[owner] + at - 1, len(data) - 1)]].astype(np.uint32)).astype(np.uint32)
    which = row[owner].astype(np.int32)
    rows, cells = [], []
    for k in (1, 2, 3):
        m = len(flat) - k + 1
        if m <= 0:
            break
        code = np.full(m, k, np.uint32)
        for j in range(k):
            code = code * np.uint32(0x01000193) + flat[j : j + m]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA6B)
        code ^= code >> np.uint32(13)
        good = owner[:m] == owner[k - 1 :]
        rows.append(which[:m][good])
        cells.append((code[good] % np.uint32(CELLS)).astype(np.int32))
    return np.concatenate(rows), np.concatenate(cells), n


def counts(column: pa.Array) -> np.ndarray:
    """Damped n-gram counts, one dense row of CELLS per text; call it with few texts at a time."""
    row, cell, n = grams(column)
    table = np.bincount(row.astype(np.int64) * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS).astype(np.float32)
    return np.log1p(table, out=table)


class Centroids:
    def __init__(self, languages: list[str], idf: np.ndarray, centre: np.ndarray, of: np.ndarray, reach: np.ndarray) -> None:
        self.languages, self.idf, self.centre, self.of, self.reach = languages, idf, centre, of, reach

    def cosines(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cosine of each text to each centroid, summed over the text's n-grams only, and whether it has any."""
        row, cell, n = grams(column)
        table = np.bincount(row.astype(np.int64) * CELLS + cell, minlength=n * CELLS)
        at = np.flatnonzero(table)
        row, cell = at // CELLS, at % CELLS
        weight = np.log1p(table[at]) * self.idf[cell]
        norm = np.sqrt(np.bincount(row, weight * weight, n))
        dots = [np.bincount(row, weight * c[cell], n) for c in self.centre]
        return np.stack(dots, axis=1) / np.maximum(norm, 1e-12)[:, None], norm > 0

    def predict(self, column: pa.Array, step: int = STEP) -> list:
        if not self.languages:
            return [["und"] * len(column), [0.0] * len(column), [True] * len(column)]
        lang, score, rejected = [], [], []
        for a in range(0, len(column), step):
            c, some = self.cosines(column.slice(a, step))
            best = c.argmax(axis=1)
            top = c[np.arange(len(c)), best]
            lang += [self.languages[self.of[b]] if s else "und" for b, s in zip(best, some)]
            score += np.where(some, np.clip(top, 0, 1), 0.0).tolist()
            rejected += (~some | (top < self.reach[best])).tolist()
        return [lang, score, rejected]


def _kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the vectors least like those already chosen. Deterministic."""
    centre = [v.mean(0)]
    near = v @ (centre[0] / max(np.linalg.norm(centre[0]), 1e-12))
    while len(centre) < min(k, len(v)):
        pick = v[int(near.argmin())]
        centre.append(pick)
        near = np.maximum(near, v @ pick)
    c = np.array(centre)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        at = (v @ c.T).argmax(1)
        for j in range(len(c)):
            if (at == j).any():
                c[j] = v[at == j].mean(0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        # A start on a stray text gathers next to nothing; such centroids go.
        size = np.bincount((v @ c.T).argmax(1), minlength=len(c))
        c = c[size >= min(size.max(), max(2, 0.01 * len(v)))]
    return c


def train(docs: DataFrame, modulus: int = 4, held: int = 2, sample: int = 4_000, per_language: int = 3, quantile: float = 0.001) -> Centroids:
    """Fits on the ``sample`` eligible rows with the smallest id hashes.

    Each sends its non-zero cells to the driver (at most CELLS values, some 10 KB), so the driver holds ``sample`` such rows.
    """
    ok = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of(F.col("doc_id"), modulus) != held)
    ids = docs.where(ok).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.where(ok).select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id")

    def sparse():
        def run(column: pa.Array) -> list:
            cells, values = [], []
            for a in range(0, len(column), STEP):
                for r in counts(column.slice(a, STEP)):
                    at = np.flatnonzero(r)
                    cells.append(at.astype(np.int16).tobytes())
                    values.append(r[at].astype(np.float16).tobytes())
            return [cells, values]

        return run

    got = append(rows, "text", [("cells", T.BinaryType()), ("values", T.BinaryType())], sparse).select("doc_id", "lang", "cells", "values").toPandas()
    got = got[got["cells"].str.len() > 0].sort_values(["doc_id", "lang", "cells"], kind="stable")
    languages = sorted(got["lang"].unique().tolist())
    if not languages:
        return Centroids([], np.ones(CELLS, np.float32), np.zeros((0, CELLS)), np.zeros(0, int), np.zeros(0))
    df = np.zeros(CELLS)
    for c in got["cells"]:
        df[np.frombuffer(c, np.int16)] += 1
    idf = (np.log((1 + len(got)) / (1 + df)) + 0.1).astype(np.float32)
    centre, of, reach = [], [], []
    for k, name in enumerate(languages):
        mine = got[got["lang"] == name]
        v = np.zeros((len(mine), CELLS), np.float32)
        for i, (c, x) in enumerate(zip(mine["cells"], mine["values"])):
            v[i, np.frombuffer(c, np.int16)] = np.frombuffer(x, np.float16)
        v *= idf
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        c = _kmeans(v, per_language)
        near = v @ c.T
        at = near.argmax(1)
        for j in range(len(c)):
            own = near[at == j, j]
            reach.append(float(np.quantile(own, quantile)) * 0.8 if len(own) else 0.0)
        centre.append(c)
        of += [k] * len(c)
    return Centroids(languages, idf, np.vstack(centre).astype(np.float32), np.array(of), np.array(reach))


def identify(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine to the nearest centroid) and ``rejected``."""
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    return append(docs, text, fields, lambda: model.predict)
