"""Spelling variants against plain versions."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from funnelspark.llm import spelling

SCHEMA = "doc_id long, text string, word string, n string, run int, Root double, key binary"


def one_apart(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    short, long = sorted((x, y), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    found = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def plain_variants(counts):
    form, near = {}, {}
    for w in counts:
        others = sorted((-counts[x], x) for x in counts if x != w and one_apart(w, x))
        near[w] = len(others)
        if others and -others[0][0] >= 10 * counts[w]:
            form[w] = others[0][1]
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], near[w], counts.get(form.get(w))))
    return sorted(map(repr, out))


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(repr, map(tuple, df.collect())))


def random_words(rng, letters, count, longest=13):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(7, longest))) for _ in range(count)})


@pytest.mark.parametrize(("letters", "count"), [("ab", 250), ("abé", 500), ("a", 30), ("aÿÀ×", 500)])
def test_index_finds_every_near_word(letters, count):
    words = random_words(random.Random(count), letters, count)
    q, w = spelling.near_pairs(words, words)
    want = sorted((i, j) for i, x in enumerate(words) for j, y in enumerate(words) if x != y and one_apart(x, y))
    assert sorted(zip(q.tolist(), w.tolist())) == want


def test_letters_the_index_lacks():
    q, w = spelling.near_pairs(["abcdefgh"], ["abcdefgz", "zbcdefgh", "zbcdefgz", "abcdefghz", "abczdefgh", "abcdefg"])
    assert q.tolist() == [0, 1, 3, 4, 5] and not w.any()


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 11, 500)
    tree = spelling.Wavelet(values, 11)
    lo = rng.integers(0, 500, 200)
    hi = np.minimum(lo + rng.integers(0, 60, 200), 500)
    symbol = rng.integers(0, 11, 200)
    a, b, smaller = tree.follow(symbol, lo, hi)
    for k in range(200):
        part = values[lo[k] : hi[k]]
        assert (a[k], b[k] - a[k], smaller[k]) == ((values[: lo[k]] == symbol[k]).sum(), (part == symbol[k]).sum(), (part < symbol[k]).sum())
    at, symbols, a, b, smaller = tree.branch(lo, hi)
    assert sorted(zip(at.tolist(), symbols.tolist())) == sorted((k, s) for k in range(200) for s in set(values[lo[k] : hi[k]].tolist()))


def test_odd_rows(spark):
    rng = random.Random(6)
    words = ["walking", "Walking", "wlking", "walkinng", "waIking", "Straßen", "ÀÉÎÕÜßÿ", "àéîõüßÿ", "division÷sign", "letters7letters", "日本walking", "short", "abcdefg" * 300]
    long = " ".join(rng.choice(words) for _ in range(20_000))
    texts = [None, "", " ", "walking", "walking walking wal-king", long, long, "walkings walkings walkingss walkingss", "WALKING\x00walkinf walkinf"]
    rows = [(i, t, "x", None, 1, 2.0, b"") for i, t in enumerate(texts)]
    rows += [(None, "walking walkiing walkiing", None, None, None, None, None), (4, texts[4], None, None, None, None, None), (None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(spelling.spelling_variants(df, spelling.altered)) == plain_variants(plain_words(rows))


def test_empty(spark):
    assert rows_of(spelling.spelling_variants(spark.createDataFrame([], SCHEMA), spelling.altered)) == []


def test_chains_ties_and_hot_keys(spark):
    """A third of all words share their outer letters; forms chain over several steps; shards and cells of a few words."""
    rng = random.Random(7)
    words = random_words(rng, "abc", 300, 9) + ["interna" + "".join(p) for p in {(rng.choice("xyz"), rng.choice("xyz"), rng.choice("uvw"), rng.choice("uvw")) for _ in range(150)}]
    counts = {w: 10 ** rng.randrange(5) * 2 for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(df, shard=50, cell=7)) == plain_variants(counts)
