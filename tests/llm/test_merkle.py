"""The Merkle manifest against a plain version, on odd input and with sources of many sizes."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from funnelspark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, Root int, tree string, at int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def levels(hashes, width):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + width]) for i in range(0, len(out[-1]), width)])
    return out


def plain(rows, width=16):
    sources = collections.defaultdict(list)
    for d, text, lang, source, n, *_ in rows:
        leaf, changed = (digest(field(d), field(source), field(lang), field(n), field(t)) for t in (text, lowered(text)))
        tampered = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        sources[source].append((d is not None, d or 0, leaf, changed if tampered else leaf, d))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: r[:3])
        trees[s] = levels([r[2] for r in sources[s]], width)
    top = levels([trees[s][-1][0] for s in names], width)
    out = []
    for k, s in enumerate(names):
        for i, (_, _, leaf, h, d) in enumerate(sources[s]):
            passed = []
            for tree, at in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    run, p = level[at // width * width : at // width * width + width], at % width
                    passed += run[:p] + run[p + 1 :]
                    h, at = digest(*run[:p], h, *run[p + 1 :]), at // width
            out.append((d, leaf, trees[s][-1][0], top[-1][0], digest(*passed), h, h == top[-1][0]))
    return out


def proven(df, width=16):
    text = F.when(merkle.sampled(F.col("doc_id")), merkle.lowered(F.col("text"))).otherwise(F.col("text"))
    got = merkle.prove(df, {"text": text}, width)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(repr, map(tuple, got.collect())))


def rows_of(*shapes):
    rest = (None, None, None, None)
    return [(*r, *rest) for r in shapes]


MANY = rows_of(
    *((i, f"T{i} Ä" if i % 7 else None, "en", f"s{i % 3}" if i % 5 else None, i) for i in range(700)),
    *[(None, "X", None, None, None)] * 3, (5, "Q", "e", "lone", 1), (5, "Q", "e", "twice", 1), (5, "Q", "e", "twice", 1), (7, "", "", "", 0),
    *((9000 + i, "B", None, f"u{i}", 1) for i in range(40)), (6, "Über Wort " * 30_000, "de", "Ü", 1),
)


@pytest.mark.parametrize("rows", [[], rows_of((1, "Ab", "en", "s", 2)), rows_of((None, None, None, None, None)), rows_of(*((i, "Ab", "en", "s", 2) for i in range(17))), MANY])
def test_proofs(spark, rows):
    assert proven(spark.createDataFrame(rows, SCHEMA)) == sorted(map(repr, plain(rows)))


def test_narrow_runs_and_partitions(spark):
    """Deep trees (runs of two); a source spread over all partitions gives the same tree as in one."""
    rows = MANY[:90]
    want = sorted(map(repr, plain(rows, 2)))
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert proven(spark.createDataFrame(rows, SCHEMA).repartition(3), 2) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_tampering_is_found(spark):
    """Every leaf whose row changed folds to another root; all others verify."""
    rows = MANY[:200]
    got = {r[0]: r for r in map(tuple, merkle.prove(spark.createDataFrame(rows, SCHEMA), {"text": F.when(F.col("doc_id") == 11, F.lit("other")).otherwise(F.col("text"))}).collect())}
    assert [d for d, r in got.items() if not r[-1]] == [11]
