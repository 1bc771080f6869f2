import random
import re

import pytest
from pyspark.sql import functions as F

from funnelspark.functions import rules as R
from funnelspark.operators import rule_table as T


def _brute(text, rules):
    """Label of the first rule that holds, rule by rule."""

    def holds(needle, match):
        return {
            "part": lambda: needle in text, "start": lambda: text.startswith(needle), "end": lambda: text.endswith(needle),
            "whole": lambda: text == needle, "word": lambda: re.search(rf"\b{re.escape(needle)}\b", text) is not None,
            "token": lambda: needle in re.split(r"[ \-|]+", text),
        }[match]()

    hits = [(p, label) for p, needle, match, label in rules if text is not None and holds(needle, match)]
    return min(hits)[1] if hits else "none"


def _labels(frame, texts, rules):
    df = frame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = T.label_by_rules(df, F.col("t"), frame(rules, T.RULE_SCHEMA), "label", "none")
    return [r["label"] for r in got.orderBy("id").collect()]


def test_five_thousand_rules_equal_brute_force(frame):
    rng = random.Random(8)
    word = lambda low, high: "".join(rng.choice("abcdé") for _ in range(rng.randint(low, high)))
    rules = [(rng.randrange(3000), word(4, 8), rng.choice(T.MATCHES), f"L{i % 50}") for i in range(4_990)]
    rules += [(3000 + i, word(1, 2), m, "short") for i, m in enumerate(["start", "end", "token", "word", "whole"] * 2)]
    texts = [rng.choice(" -|").join(word(1, 7) for _ in range(rng.randint(1, 5))) for _ in range(400)]
    texts += [n for _, n, _, _ in rules[:40]] + ["", None, " ", texts[0]]
    assert _labels(frame, texts, rules) == [_brute(t, rules) for t in texts]


def test_rules_with_odd_needles(frame):
    rules = [(0, "", "whole", "empty"), (1, "a.b", "part", "dot"), (2, "e\\E(f", "word", "quote"), (3, "x(", "part", "bracket"), (4, "😀", "part", "face"),
             (5, None, "part", "null"), (6, "zz", "unknown", "unknown"), (7, "q", "part", "second"), (7, "q", "part", "first")]
    assert _labels(frame, ["", "a.b", "axb", "x(y", "so 😀!", "zz", "q", None, "a e\\E(f b", "ae\\E(f"], rules) == [
        "empty", "dot", "none", "bracket", "face", "none", "first", "none", "quote", "none"]
    assert _labels(frame, ["a"], [(0, "", "part", "all")]) == ["all"]
    assert _labels(frame, ["a", None], []) == ["none", "none"]
    assert _labels(frame, [], rules) == []


def test_patterns_become_needles(frame):
    assert T.pattern_rules([(r"^a$|b c|^d|e\.f$", "x")]) == [(0, "a", "whole", "x"), (0, "b c", "part", "x"), (0, "d", "start", "x"), (0, "e.f", "end", "x")]
    for broken in ("a.b", "step.?down", "(a)", r"\d"):
        with pytest.raises(ValueError):
            T.pattern_rules([(broken, "x")])
    texts = ["ppc - north", "meta ads", "google organic", "print", "", "x"]
    df = frame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = T.label_by_rules(df, F.col("t"), frame(T.pattern_rules(R.BRIEF_CHANNEL_BY_SOURCE), T.RULE_SCHEMA), "label", "Other")
    want = df.select("id", R.brief_channel(F.col("t")).alias("label"))
    assert sorted(got.select("id", "label").collect()) == sorted(want.collect())


def test_plan_does_not_grow_with_the_rules(spark, frame):
    df = frame([(1, "abcdef")], "id int, t string")

    def plan(n):
        rules = spark.range(n).select(
            F.col("id").cast("int").alias("priority"), F.concat(F.lit("abc"), F.col("id").cast("string")).alias("needle"), F.lit("part").alias("match"), F.lit("x").alias("label")
        )
        return T.label_by_rules(df, F.col("t"), rules, "label")._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(5) == plan(5_000)
