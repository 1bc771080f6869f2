"""Language identification against a plain version, on texts without letters and on ties."""

import collections
import math
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from funnelspark.llm import langid

TEXTS = [None, "", "…", "€ 5 — 7", "😀", "12 34", "́̂", "und", "Straße über allen", "naïve café", "日本語 テキスト", "हिन्दी", "a" * 3000, "the THE the", "x😀y"]


def plain_cells(text):
    """Hash cell counts of byte n-grams (1 to 3) inside words padded by one edge mark."""
    found = collections.Counter()
    words, word = [], ""
    for ch in (text or "") + " ":
        if unicodedata.category(ch)[0] in "LM":
            word += ch
        elif word:
            words.append(word)
            word = ""
    for w in words:
        if not any(unicodedata.category(c)[0] == "L" for c in w):
            continue
        b = [0] + [x + 32 if 65 <= x <= 90 else x for x in w.encode()]
        for k in (1, 2, 3):
            for i in range(len(b) - k + 1):
                code = k
                for x in b[i : i + k]:
                    code = (code * 0x01000193 + x) & 0xFFFFFFFF
                code ^= code >> 15
                code = code * 0x85EBCA6B & 0xFFFFFFFF
                code ^= code >> 13
                found[code % langid.CELLS] += 1
    return found


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    centre = rng.random((4, langid.CELLS)).astype(np.float32)
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    centre[3] = centre[1]  # two languages with one centroid: a tie
    return langid.Centroids(["de", "en", "fr"], rng.random(langid.CELLS).astype(np.float32) + 0.1, centre, np.array([0, 1, 1, 2]), np.full(4, 0.2))


@pytest.mark.parametrize("step", [1, 4, 100])
def test_prediction_is_the_nearest_centroid(model, step):
    lang, score, rejected = model.predict(pa.array(TEXTS, pa.string()), step)
    for text, got, value, off in zip(TEXTS, lang, score, rejected):
        cells = plain_cells(text)
        if not cells:
            assert (got, value, off) == ("und", 0.0, True), text
            continue
        weight = {c: math.log1p(n) * float(model.idf[c]) for c, n in cells.items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        cosines = [sum(w * float(c[i]) for i, w in weight.items()) / norm for c in model.centre]
        assert value == pytest.approx(max(cosines), abs=1e-6)
        assert got == model.languages[model.of[int(np.argmax(np.round(cosines, 6)))]], text
        assert off == (max(cosines) < 0.2)


def test_texts_without_letters_are_und():
    got = langid.Centroids(["en"], np.ones(langid.CELLS, np.float32), np.ones((1, langid.CELLS)), np.zeros(1, int), np.zeros(1))
    lang, score, _ = got.predict(pa.array(TEXTS[:7], pa.string()))
    assert set(lang) == {"und"} and set(score) == {0.0}
