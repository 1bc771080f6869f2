"""The training-data operators against brute-force versions and on odd input."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from funnelspark.llm import ann, decontaminate, langid, mixing, ngram_join, pii, quality, suffix_dedup, token_counts, toxicity
from funnelspark.llm.ragged import slices, text_bytes, word_spans

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, Score double, spans string, items string, size int, _entities int"


def odd_rows():
    """NULLs in every column, empty and long texts, ties, repeated rows, characters of all widths."""
    rng = random.Random(5)
    words = ["the", "fox", "Über", "naïve", "日本", "🙂", "a", "idiot", "x1"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    texts = [None, "", " ", "\n\t", "one", "one two three", long, long, "Same text here again and again " * 8, "Same text here again and again " * 8, "é" * 60, "\x00\x0b", "Mail a.b@c.org, +1 (212) 555-0000."]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t) if t else None, 1.0, "x", None, 3, 1) for i, t in enumerate(texts)]
    return rows + [rows[8], (None, "Same text here again and again " * 8, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (5, None, None), (None, 1, 1), (6, 7, 7), (8, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "one two three"), (2, None), (3, ""), (None, "one"), (4, "Same text here again and again same text here again and again"), (4, "again")], "item_id long, text string")


def spaced(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())


def lower(b):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def test_slices_and_words():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab c", None, "", " d", "ef" * 9])], names=["t"])
    assert sum(p.num_rows for p in slices(batch, "t", 4)) == 5
    data, offsets = text_bytes(batch.column(0))
    start, end, row = word_spans(data, offsets, data != 32)
    assert [(bytes(data[a:b]).decode(), r) for a, b, r in zip(start, end, row)] == [("ab", 0), ("c", 0), ("d", 3), ("ef" * 9, 4)]


# Op 1


def components(rows, n=5, percent=75):
    """Brute force: all pairs, then reachability."""
    sets = []
    for _, text in rows:
        w = [lower(x) for x in spaced(text)]
        sets.append({tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set())
    name = list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                name[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)].append(d)
    return sorted(((d, len(s), (min(least[root(i)]) if least[root(i)] else None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(seed, count=160):
    rng = random.Random(seed)
    out = []
    while len(out) < count:
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 80))]
        for _ in range(rng.choice([1, 1, 2, 3, 9])):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"w{rng.randrange(400)}"
            if rng.random() < 0.3:
                text += base[: rng.randrange(len(base))]
            out.append((len(out) * 7 % 1009, " ".join(text)))
    return out


@pytest.mark.parametrize("seed,percent", [(1, 75), (2, 75), (3, 50), (4, 100)])
def test_ngram_join_equals_all_pairs(spark, seed, percent):
    rows = near_copies(seed)
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == components(rows, percent=percent)


def test_ngram_join_odd(spark, odd, empty):
    got = sorted((tuple(r) for r in ngram_join.join_components(odd).collect()), key=str)
    assert got == components([(r[0], r[1]) for r in odd_rows()])
    assert ngram_join.join_components(empty).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 8, 10, 11, 12]


def test_near_copies_are_not_paired_all_with_all(spark):
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[: i % 140], f"new{i}", *base[i % 140 + 1 :]])) for i in range(400)]
    seen = []
    whole = ngram_join.linked
    ngram_join.linked = lambda pairs, sets, percent: (seen.append(pairs.count()), whole(pairs, sets, percent))[1]
    try:
        got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r["component_id"] for r in got.collect()} == {0}
    finally:
        ngram_join.linked = whole
    assert sum(seen) < 2000


@pytest.mark.parametrize("seed,percent,cell", [(1, 75, 1000), (3, 50, 3), (4, 100, 1000)])
def test_ngram_links_are_all_pairs(spark, monkeypatch, seed, percent, cell):
    """Every pair within a group is a link, not only those that join it; columns dealt into cells lose none and repeat none."""
    monkeypatch.setattr(ngram_join, "CELL", cell)
    rows = near_copies(seed)
    base = [f"v{i}" for i in range(60)]
    rows += [(2000 + i, " ".join([*base[: i % 20], f"x{i % 12}", *base[i % 20 + 1 :]])) for i in range(30)] + [(3000, None), (3001, "")]
    sets = {}
    for d, t in rows:
        w = [lower(x) for x in spaced(t)]
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()
    near = lambda x, y: x and y and 100 * len(x & y) >= percent * len(x | y)
    want = {d: sum(1 for e in sets if e != d and near(sets[d], sets[e])) for d in sets}
    distinct = list(set(sets.values()))
    pairs = sum(1 for i, x in enumerate(distinct) for y in distinct[:i] if near(x, y))
    members, links = ngram_join.join_links(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    members, links = members.collect(), links.collect()
    assert {r["doc_id"]: r["n_links"] for r in members} == want
    assert len(links) == len({(r["a"], r["b"]) for r in links}) == pairs and all(r["a"] < r["b"] for r in links)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members), key=str) == components(rows, percent=percent)
    of = {r["doc_id"]: r["key"] for r in members}
    found = {frozenset((r["a"], r["b"])) for r in links}
    assert all(of[d] == of[e] or ({of[d], of[e]} in found) == bool(near(sets[d], sets[e])) for d in sets for e in sets)


# Op 2


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ["scum", "idiot", "worthless", "clown", "cl"]
    a = toxicity.Automaton(terms)
    rng = random.Random(2)
    words = []
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randrange(2)] = rng.choice(["", "a", "s", "w", "zz"])
        words.append("".join(w) or "q")
    flat = "".join(words).encode()
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    term, found = a.match(np.frombuffer(flat, np.uint8), start, end)
    for w, t, e in zip(words, term, found):
        near = [(edits(w, x), x) for x in terms if edits(w, x) <= toxicity._edits(x.encode())]
        assert (t >= 0) == bool(near), w
        if near:
            assert e == min(near)[0]


def test_toxicity_context():
    a = toxicity.Automaton(["idiot"])
    x = toxicity.features(pa.array(["you are an idiot", 'she called him "an idiot" today', "an idoot", None, ""]), a)
    f = dict(zip(toxicity.FEATURES, x.T))
    assert (f["abuse"] > 0).tolist() == [True, False, False, False, False]
    assert (f["quoted"] > 0).tolist() == [False, True, False, False, False]
    assert (f["fuzzy"] > 0).tolist() == [False, False, True, False, False]
    assert f["address"].tolist() == [1, 0, 0, 0, 0]


def test_terms_and_texts_are_folded_alike(spark):
    a = toxicity.Automaton(["b1tch2", "ärger", "4ss"])
    x = toxicity.features(pa.array(["so B1TCH2 there", "so bitch2 there", "so ärger there", "an a55 there", "an asz there"]), a)
    f = dict(zip(toxicity.FEATURES, x.T))
    assert f["abuse"].astype(bool).tolist() == [True, True, True, True, False] and not f["fuzzy"].any()
    rows = [(i, f"w{i} B1tch2 v{i}" if i % 2 else f"w{i} plain ÄRGER v{i}", i % 2) for i in range(40)]
    assert toxicity.lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int")) == ["bitch2"]


def test_toxicity_held_out(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs.select("doc_id", "text"), toxicity.train(docs, marks)).join(marks, "doc_id").select("doc_id", "predicted", "toxic").toPandas()
    got = got[[zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]]
    assert got[got["predicted"] == 1]["toxic"].mean() > 0.97
    assert got[got["toxic"] == 1]["predicted"].mean() > 0.7


def test_lexicon_has_every_term(spark):
    """More qualifying terms than one automaton holds: all are learned, and a text with only the rarest of them is a hit."""
    rng = random.Random(9)
    terms = sorted({"".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(2)) + "x" for _ in range(400)})[:230]
    rows = []
    for k, t in enumerate(terms):
        rows += [(100 * k + j, f"p{k}q{j} {t} r{k}q{j}", 1) for j in range(8 if k == 100 else 9)]
    rows += [(10**6 + j, f"u{j} plain v{j}", 0) for j in range(300)]
    found = toxicity.lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert len(terms) > toxicity.TERMS and set(found) == set(terms)
    x = toxicity.features(pa.array([f"so {terms[100]} there", "so plain there"]), toxicity.Lexicon(found))
    assert x[:, toxicity.FEATURES.index("abuse")].astype(bool).tolist() == [True, False]
    few, words = terms[:40], [w for t in terms for w in (t, t[1:], t + "a")]
    data, end = np.frombuffer("".join(words).encode(), np.uint8), np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    whole, parts = (a.match(data, start, end) for a in (toxicity.Automaton(few), toxicity.Lexicon(few, 7)))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and (whole[0] >= 0).any()


# Ops 3, 5, 8


def test_token_counts_equal_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, count = Tokenizer.from_file(path), token_counts.counter(path)
    rng = random.Random(1)
    pieces = ["a", "the", " ", "  ", "\n", "é", "日本", "'s", "!!", "$$$", "12", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|", "aaaa", "🙂", "\r\n", "　", "\x00", "token"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(50))) for _ in range(2000)] + ["", None, "a" * 5000, " " * 3000]
    size, tokens = count(pa.array(texts))
    assert tokens.tolist() == [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert size.to_pylist() == [len((t or "").encode()) for t in texts]


def test_quality_held_out(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs.select("doc_id", "text"), quality.train(docs, marks)).join(marks, "doc_id").select("doc_id", "predicted", "quality").toPandas()
    got = got[[zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]]
    assert (got["predicted"] == got["quality"]).mean() > 0.97


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    right = [((quality.fit(x, y, pairs=k).score(x) > 0.5) == y).mean() for k in (0, 1)]
    assert right[0] < 0.6 and right[1] > 0.85


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.identify(docs.select("doc_id", "text", "lang"), langid.train(docs)).select("doc_id", "lang", "lang_pred").toPandas()
    got = got[[zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]]
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98


def test_scorers_odd(spark, odd, empty, labels):
    none = labels.where("false")
    for docs in (odd, empty):
        for marks in (labels, none):
            for got in (toxicity.toxicity(docs, toxicity.train(docs, marks)), quality.quality(docs, quality.train(docs, marks))):
                rows = got.collect()
                assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
        got = langid.identify(docs, langid.train(docs)).collect()
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if not re.search(r"[^\W\d_]", r["text"] or ""))
        assert {r["lang_pred"] for r in got} <= {"und", "en"}


# Op 4


def hits(text, items, window=10):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", lower((text or "").encode()))
    hit, met = set(), set()
    for i, t in items:
        x = re.findall(rb"[0-9a-z\x80-\xff]+", lower((t or "").encode()))
        size = min(window, len(x))
        own = {tuple(x[k : k + size]) for k in range(len(x) - size + 1)} if size and i is not None else set()
        for k in range(len(w) - size + 1):
            if tuple(w[k : k + size]) in own:
                hit |= set(range(k, k + size))
                met.add(str(i))
    return len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WORDS, 20])
def test_decontamination_equals_scan(spark, odd, empty, bench, monkeypatch, block):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", block))
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(80)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(16)))) for i in range(12)]
    got = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).drop("spans")
    assert sorted(map(tuple, got.collect())) == sorted((i, *hits(t, items)) for i, t in rows)
    items = [tuple(r) for r in bench.collect()]
    got = decontaminate.decontaminate(odd, bench).drop("spans")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((r[0], *hits(r[1], items))) for r in odd_rows())
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.decontaminate(odd, bench.where("false")).collect()} == {0}


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WORDS, 3])
def test_cut_texts(spark, odd, bench, monkeypatch, block):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", block))
    cut = decontaminate.without_spans(odd, bench)
    assert cut.columns == odd.columns
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert 5 not in rows and 0 in rows and rows[12]["text"] == odd_rows()[12][1]
    items = [tuple(r) for r in bench.collect()]
    assert all(hits(r["text"], items)[1] == 0 for r in rows.values() if r["doc_id"] == 8)


# Op 6


@pytest.mark.parametrize("copies", [0, 700])
def test_neighbours(spark, monkeypatch, copies):
    monkeypatch.setattr(ann, "PART_ROWS", 256)
    monkeypatch.setattr(ann, "BLOCK", 128)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2500, 16)) + 4 * rng.normal(size=(12, 16))[rng.integers(0, 12, 2500)]
    x[:copies] = x[0]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + [(None, x[1].tolist()), (9001, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [1.0]), (9400, [None] * 16), (5, x[5].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(table, F.col("vec_id") % 100 == 0).toPandas()
    found, total = 0, 0
    for q in range(0, 2500, 100):
        own = got[got["query_id"] == q].sort_values("rank")
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert own["rank"].tolist() == list(range(1, 11)) and np.allclose(own["score"], d[own["vec_id"]], rtol=0, atol=1e-12)
        assert own[["score", "vec_id"]].apply(tuple, axis=1).is_monotonic_increasing
        found += len(set(own["vec_id"]) & set(np.lexsort((np.arange(2500), d))[:10].tolist()))
        total += 10
    assert found / total >= 0.9
    assert set(got["query_id"]) == set(range(0, 2500, 100))


def test_neighbours_of_few(spark):
    table = spark.createDataFrame([(100, [1.0, 0.0]), (3, [0.0, 1.0]), (200, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.search(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(100, 1, 200), (100, 2, 3), (200, 1, 3), (200, 2, 100)]
    assert got[1][3] == math.sqrt(2)
    assert ann.search(table.where("false"), F.col("vec_id") % 100 == 0).count() == 0


# Op 7


def test_surrogates(spark, odd, empty):
    text = "Ann.Lee22@Mail.example.org ann.lee22@mail.example.org +44 (212) 555-7713 4111 1111 1111 1111 4111-1111-1111-1111 240.56.125.154 123-45-6789 Mr. John Smith MRS. no, Frau Anna Schmidt 9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    docs = spark.createDataFrame([(1, text), (2, "again ann.lee22@mail.example.org and Mr. John Smith")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.surrogates(docs, "k").collect()}
    new, found = rows[1]["text"], rows[1]["n_entities"]
    assert found == 10
    for part in ("ee22", "555-7713", "1111 1111", "240.56", "123-45", "John", "Smith", "Anna", "9233A8"):
        assert part not in new
    a, b = re.findall(r"\S+@\S+", new)
    assert a == b and a in rows[2]["text"]
    assert re.search(r"\+44 \(\d{3}\) \d{3}-\d{4} ", new)
    one, two = re.search(r"(4\d{3} \d{4} \d{4} \d{4}) (4\d{3}-\d{4}-\d{4}-\d{4})", new).groups()
    assert one.replace(" ", "") == two.replace("-", "")
    digits = [int(c) for c in one if c != " "][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    man = re.search(r"Mr\. (\w+n \w+r)", new).group(1)
    assert man in rows[2]["text"] and re.search(r"Frau \w+na \w+r", new)
    assert re.search(r"\b[0-9A-F]{40}\b", new)
    assert pii.surrogates(docs, "k").collect() == pii.surrogates(docs, "k").collect() and pii.surrogates(docs, "other").collect()[0]["text"] != new
    got = pii.replace(odd, "k")
    assert got.columns == odd.columns and got.count() == odd.count()
    same = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] is not None and r["doc_id"] != 12}
    assert same == {r[0]: r[1] for r in odd_rows() if r[0] is not None and r[0] != 12}
    assert pii.surrogates(empty).count() == 0


def test_surrogates_stay_distinct(spark):
    """3,000 addresses of one network and as many short numbers collide; each still gets a replacement of its own."""
    rows = [(i, f"call 555-{i // 100 % 1000:03d}-{i % 100:02d}00 or {i % 1000:03d}-{i % 97:02d}-{i:04d}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = [re.findall(r"[\d-]{11,12}", t) for _, t in rows]
    new = [re.findall(r"[\d-]{11,12}", r["text"]) for r in pii.surrogates(docs, "k").orderBy("doc_id").collect()]
    kinds = collections.defaultdict(dict)
    for a, b in zip(old, new):
        assert [len(x) for x in a] == [len(x) for x in b]
        for x, y in zip(a, b):
            assert kinds[len(x)].setdefault(x, y) == y
    for found in kinds.values():
        assert len(set(found.values())) == len(found) and not set(found.values()) & set(found)


# Op 6, parts too small for k


def test_visits_hold_more_than_k_rows():
    """A query sure of a part with three rows goes on to the next likely ones; with too few rows in all, every part is visited."""
    router = ann.Router([np.eye(4), np.zeros(4), 50 * np.eye(4), np.zeros(4)], 4)
    x = np.array([[1.0, 0.2, 0.1, 0.0]])
    assert router.visits(x, 0.5, np.array([100, 9, 9, 9]), 11) == [[0]]
    assert router.visits(x, 0.5, np.array([3, 4, 5, 900]), 11) == [[0, 1, 2]]
    assert router.visits(x, 0.5, np.array([3, 0, 1, 2]), 11) == [[0, 1, 2, 3]]


def test_sample_bound_takes_the_smallest_hashes(spark):
    rows = spark.range(9000).select(F.col("id").alias("vec_id"), F.lit(b"").alias("v"))
    want = [r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(500).collect()]
    assert [r[0] for r in ann._sample(rows, 9000, 500).collect()] == want
    assert ann._sample(rows.limit(40), 40, 500).count() == 40 and ann._sample(rows.limit(0), 0, 500).count() == 0


# Op 9


def removed(rows, size=50):
    least = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            least.setdefault(b[k : k + size], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if i is not None and least[b[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,hot,most,bases", [(1, 50_000, 200_000, (1, suffix_dedup.BASES[1])), (2, 3, 200_000, suffix_dedup.BASES), (3, 1, 50, suffix_dedup.BASES)])
def test_suffix_dedup_equals_scan(spark, seed, hot, most, bases):
    """Under base 1 strings with their bytes in another order share a hash; the next base tells them apart."""
    rng = random.Random(seed)
    shared = ["".join(rng.choice("ab é") for _ in range(rng.randrange(30, 130))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice([rng.choice(shared), "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(40))), "a" * rng.randrange(70)]) for _ in range(rng.randrange(6)))
        rows.append((i * 13 % 127, text))
    rows += [(200, rows[3][1]), (201, rows[3][1]), rows[5], (None, rows[7][1])]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot, most=most, bases=bases).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == removed(rows)


def test_suffix_dedup_odd(odd, empty):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert sorted((tuple(r) for r in suffix_dedup.dedup(odd).drop("kept").collect()), key=str) == removed(rows)
    assert suffix_dedup.dedup(empty).count() == 0


def test_texts_of_one_key_stay_apart():
    """Two texts whose first hash agrees are two texts: an anchor that only they share is shared."""
    h = np.array([1 << 40, 1 << 41, 1 << 40], np.uint64)
    row = suffix_dedup._rows(1, np.zeros(3, np.int32), np.array([7, 7]), np.array([1, 2], np.uint32), np.array([0, 0, 1]), h)
    out = suffix_dedup._gathered(suffix_dedup._shared(None, pa.Table.from_batches([row]), 4, 9))
    assert set(out["key"].tolist()) == {7} and set(out["hash"].tolist()) == {1 << 40}


def test_packed_anchors_stay_small_in_many_blocks():
    """What names a text does not outweigh the anchor, though nearly every anchor of a text is in a block of its own."""
    rng = np.random.default_rng(1)
    blocks, texts, each = 1200, 1500, 40
    keep = np.uint64((1 << 64) - (1 << 22))
    h = rng.integers(0, 1 << 63, texts * each).astype(np.uint64) * np.uint64(2) & keep
    keys, at = np.sort(rng.choice(3_000_000, texts, replace=False)), np.repeat(np.arange(texts), each)
    rows = suffix_dedup._rows(1, suffix_dedup._block_of(h, blocks), keys, np.zeros(texts, np.int64), at, h)
    assert sum(len(v) for c in rows.schema.names[2:] for v in rows.column(c).to_pylist()) < 9 * len(h)
    back = suffix_dedup._gathered(pa.Table.from_batches([rows]))
    assert sorted(zip(back["key"].tolist(), back["hash"].tolist())) == sorted(zip(keys[at].tolist(), h.tolist()))


def test_anchors_fill_all_blocks():
    """The least hash of a window is a small one; the blocks must not be."""
    rng = np.random.default_rng(3)
    texts = pa.array(["".join(map(chr, rng.integers(97, 123, 20_000))) for _ in range(4)])
    names = np.concatenate([np.unique(low) for *_, low in suffix_dedup.anchors(texts, suffix_dedup._kept(16))])
    counts = np.bincount(suffix_dedup._block_of(names, 16), minlength=16)
    assert counts.max() < 1.5 * counts.mean() and counts.min() > counts.mean() / 1.5


def test_numbers_come_back_from_few_bytes():
    rng = np.random.default_rng(2)
    first = np.array([0, 1, 40, 41])
    for v in (rng.integers(-(1 << 62), 1 << 62, 90), np.sort(rng.integers(-5, 1 << 40, 90)), np.arange(90) * 600 + 7, np.zeros(90, np.int64), np.full(90, -3), rng.integers(0, 9, 90) << 50):
        packed = suffix_dedup._narrow(v, first)
        back = [suffix_dedup._wide(p, n) for p, n in zip(packed, np.diff(np.append(first, len(v))))]
        assert np.concatenate(back).view(np.int64).tolist() == v.tolist()
    assert len(suffix_dedup._narrow(np.arange(90) * 600 + 7, np.array([0]))[0]) < 300 and suffix_dedup._narrow(np.zeros(90, np.int64), first) == [b""] * 4


def test_spans_of_a_bucket_are_merged_by_text():
    removed = suffix_dedup._removed(np.array([4, 4, 4, 8, 4, 12]), np.array([100, 0, 50, 7, 300, 1]), np.array([180, 60, 100, 60, 350, 55]))
    rows = suffix_dedup._packed_spans(removed, 4)
    firsts = pa.table({"n": [12, 8, 4, 16], "tk": [5, 6, 7, 8], "least": [1, 2, 3, 4]})
    got = {(r["doc_id"], r["tk"]): [(x["a"], x["b"]) for x in r["spans"]] for r in suffix_dedup._text_spans(None, rows, firsts).to_pylist()}
    assert got == {(3, 7): [(0, 180), (300, 350)], (2, 6): [(7, 60)], (1, 5): [(1, 55)]}
    # Two texts of one document under one first hash share their row, so the join gives each text once.
    one = suffix_dedup._text_spans(None, rows, pa.table({"n": [12, 8, 4, 16], "tk": [5, 6, 6, 8], "least": [1, 2, 2, 4]}))
    assert sorted((r["doc_id"], r["tk"]) for r in one.to_pylist()) == [(1, 5), (2, 6)] and suffix_dedup._text_spans(None, rows.slice(0, 0), firsts).num_rows == 0


def test_hash_collisions_take_the_next_base():
    rows = [b"ab" * 30, b"ba" * 30]
    data = np.frombuffer(b"".join(rows), np.uint8)
    e = {"hash": np.zeros(2, np.uint64), "key": np.array([1, 2]), "doc": np.array([1, 2]), "place": np.zeros(2, np.int32), "range": np.array([[0, 10], [0, 10]], np.uint8), "bytes": data}
    with pytest.raises(suffix_dedup.Collision):
        suffix_dedup._sorted_spans(e, 1)
    assert suffix_dedup.settled(lambda base: suffix_dedup._sorted_spans(e, base), (1, suffix_dedup.BASES[0])).num_rows == 0


def test_texts_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame([(i, f"{'the same words again and again ' * 4}{i % 7}") for i in range(60)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = suffix_dedup.dedup(spark.read.parquet(str(tmp_path / "d")))
        got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"ReusedExchange \[doc_id#\d+L, text#\d+, tk#\d+L\]", plan)


def test_suffixes_are_sorted():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[500:900] = data[1500:1900]
    suffix = rng.integers(0, 2900, 1200)
    group = np.sort(rng.integers(0, 9, 1200))
    order = suffix_dedup.sort_suffixes(data, suffix_dedup.Prefixes(data), suffix, group)
    key = [(g, bytes(data[s : s + 50])) for g, s in zip(group[order], suffix[order])]
    assert key == sorted(key) and sorted(order.tolist()) == list(range(1200))


def test_more_names_than_short_surrogates(spark, monkeypatch):
    """Two syllables make eight short names a gender: the check ends all the same, with names of more syllables and the gender in them."""
    monkeypatch.setattr(pii, "_LATIN", ["ba", "be"])
    monkeypatch.setattr(pii, "_CYRILLIC", ["ба", "бе"])
    rounds, write = [], pii.materialise

    def counted(df, label):
        rounds.append(label)
        assert len(rounds) < 40
        return write(df, label)

    monkeypatch.setattr(pii, "materialise", counted)
    rows = [(i, f"{t} {'ABCDEFGHIJ'[i // 10]}{'abcdefghij'[i % 10]}{e}") for t, e, a, b in (("Mr", "q", 0, 20), ("Mrs", "w", 20, 40)) for i in range(a, b)]
    got = [r["text"] for r in pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(set(g.split(" ")[1] for g in got)) == 40
    assert all(re.fullmatch(r"Mr (B[ae])(b[ae]){2,}r|Mrs (B[ae])(b[ae]){2,}ra", g) for g in got)


# Op 10


def test_mixing(spark, odd, empty):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(30))), rng.choice(["b", "a", "c", None, "é"]) if i % 3 else "a") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    names = sorted(size, key=lambda s: (s is None, s or ""))
    open_, left, want = {s: k % 3 + 1 for k, s in enumerate(names)}, float(sum(size.values())), {}
    while open_:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        full = [s for s in open_ if share[s] > 3 * size[s]]
        for s in full or list(open_):
            want[s] = 3.0 * size[s] if full else share[s]
            left -= want[s] if full else 0
            del open_[s]
    for s in names:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1
    order = [r["position"] for r in got if r["position"] is not None]
    assert order == sorted(order) and 0 <= order[0] and order[-1] <= 1
    where = lambda rows: np.mean([r["position"] for r in rows if r["source"] == names[0] and r["taken"]])
    late = mixing.mix(docs, schedules=mixing.SCHEDULES[::-1]).collect()
    assert where(got) < where(late) and {r["doc_id"]: r["taken"] for r in got} == {r["doc_id"]: r["taken"] for r in late}
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and {r["size"] for r in rows if r["doc_id"] == 0} == {0}
    assert mixing.mix(empty).count() == 0


def test_mixing_positions_of_every_pass(spark):
    """Sources taken up to three times have a position for each pass, and their words add up to what is taken."""
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(30))), "b" if i % 9 == 0 else "c" if i % 9 == 1 else "a") for i in range(900)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got, each = mixed.collect(), mixing.schedule(mixed).collect()
    words, epochs = collections.Counter(), collections.defaultdict(set)
    for e in each:
        assert e["words"] > 0
        words[e["doc_id"]] += e["words"]
        epochs[e["source"]].add(e["epoch"])
    assert [e["position"] for e in each] == sorted(e["position"] for e in each)
    for r in got:
        assert words[r["doc_id"]] == r["taken"] and r["positions"] == sorted(r["positions"])
        assert (r["positions"] or [None])[0] == r["position"]
        assert len(r["positions"]) == (math.ceil(r["taken"] / r["size"]) if r["taken"] else 0)
    most = {r["source"]: r["target"] / r["source_size"] for r in got}
    assert max(most.values()) > 2 and all(len(epochs[s]) == math.ceil(m - 1e-9) for s, m in most.items())
    # Late training has every source: the last pass of each reaches to the end.
    for s in most:
        assert max(e["position"] for e in each if e["source"] == s) > 0.97


# Pipeline


def test_pipeline_stages(spark):
    """Each stage against brute force on the smallest tables: what goes, what stays, what is left in the texts."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard", "decontaminate", "pii", "mixing"]
    first = stages["toxicity"](spark, docs, FOLDER)
    assert first.schema == docs.schema
    second = stages["ngram_jaccard"](spark, docs, FOLDER)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(d for d, _, c in components(rows) if d == c)
    third = stages["decontaminate"](spark, docs, FOLDER).collect()
    left = {d for d, t in rows if hits(t, items)[0] > hits(t, items)[1] or not hits(t, items)[4]}
    assert {r["doc_id"] for r in third} == left
    clean = {d: t for d, t in rows if not hits(t, items)[4]}
    assert all(r["text"] == clean[r["doc_id"]] for r in third if r["doc_id"] in clean) and all(r["n_chars"] == len(r["text"]) for r in third)
    fourth = stages["pii"](spark, docs, FOLDER)
    private = {m for _, t in rows for m in re.findall(r"\S+@\S+\.com|\+1 \(\d{3}\) [\d-]+|\b\d{16}\b|[0-9a-f]{40}", t)}
    assert fourth.columns == docs.columns and private
    assert not any(p in r["text"] for r in fourth.collect() for p in private if p in r["text"])
    last = corpus_pipeline.run(spark, FOLDER)
    assert 0 < last.count() <= docs.count() and last.where("taken > 3 * size").count() == 0


def test_pipeline_odd(spark, odd, empty, labels, bench, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if name != "mixing":
                assert docs.columns == odd.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
