"""SimHash near-duplicates against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from funnelspark.llm import simhash

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, print string, node int, Component_id double, fingerprint binary"


def lowered(b):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def plain_print(text):
    w = [lowered(x) for x in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), seed=42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_labels(values, bits=3):
    """Smallest reachable index of each value, all pairs compared."""
    values = np.array(values, np.uint64)
    label = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= bits) for v in values]
    changed = True
    while changed:
        new = np.array([label[x].min() for x in near])
        changed = (new != label).any()
        label = new
    return label.tolist()


def plain(rows):
    prints = [plain_print(r[1]) for r in rows]
    label = plain_labels(prints) if rows else []
    least = {}
    for r, k in zip(rows, label):
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    return sorted(repr((r[0], f"{p:016x}", least.get(k))) for r, p, k in zip(rows, prints, label))


def found(df):
    out = simhash.near_duplicates(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(map(repr, map(tuple, out.collect())))


def test_hashes_of_every_length():
    rng = random.Random(1)
    data = np.frombuffer(rng.randbytes(6000), np.uint8)
    start, size = np.array([rng.randrange(5700) for _ in range(900)]), np.array([*range(300), *(rng.randrange(300) for _ in range(600))])
    want = [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), seed=42) for a, n in zip(start, size)]
    assert simhash.xxh64(data, start, size).tolist() == want


def test_odd_rows(spark):
    rng = random.Random(2)
    long = " ".join(rng.choice(["the", "fox", "Über", "naïve", "日本", "🙂", "a", "B" * 200]) for _ in range(60_000))
    texts = [None, "", " \n\t", "one", "ONE", "one two", "One  two", "one two three", "one two three four", "a a a a a a a", long, long, long + " end", "é" * 60, "\x00\x0b\x1fx", "Äb ÄB"]
    rows = [(i, t, "x", 1, 2.0, b"") for i, t in enumerate(texts)] + [(None, "one two", None, None, None, None), (None, "seen once", None, None, None, None), (3, "one", None, None, None, None), (3, "one", None, None, None, None)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_empty(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("name", ["documents"])
def test_query_on_whole_table(spark, name):
    got = entry.queries()["op11_simhash"](spark, FOLDER)
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select("doc_id", "text").collect()]
    assert sorted(map(repr, map(tuple, got.collect()))) == plain(rows)


def scattered(rng, n, families, size):
    """Random points and families of points a few bits apart, chains and dense balls among them."""
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(families):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    chain = rng.getrandbits(64)
    for k in range(20):
        chain ^= 0b111 << (3 * k)
        out.add(chain)
    return sorted(out)


def test_tree_in_memory_finds_all_components(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 16)
    values = scattered(random.Random(3), 2500, 30, 60)
    a, b = simhash.joining_links(np.array(values, np.uint64), 3)
    assert (np.bitwise_count(a ^ b) > 3).any()  # chains are joined through their first point
    at = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))
    for x, y in zip(a.tolist(), b.tolist()):
        label[at[x]] = at[y]
    assert label == plain_labels(values)


def test_shards_meet_every_near_pair(spark):
    """Several rounds of splits, a third of all points in one dense ball: each near pair shares a shard and no point is lost."""
    rng = random.Random(4)
    values = scattered(rng, 3000, 1, 1500)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = simhash.shards(spark.createDataFrame(signed, "print long"), 3, 100)
    homes = {}
    for node, p in got.collect():
        homes.setdefault(p % (1 << 64), set()).add(node)
    assert set(homes) == set(values)
    assert len(set().union(*homes.values())) > 20
    points = np.array(values, np.uint64)
    for v in values:
        for w in points[np.bitwise_count(points ^ np.uint64(v)) <= 3].tolist():
            assert homes[v] & homes[w]
