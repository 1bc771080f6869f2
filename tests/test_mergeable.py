"""Distinct counts and quantiles merged from daily tables, against plain versions."""

import random
import statistics
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.operators import measures as T
from funnelspark.operators import mergeable as M

SCHEMA = "site string, day date, who string, x double"
DAY = date(2024, 1, 1)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(8)
    sites = ["a", "b", None]
    return [(rng.choice(sites), DAY + timedelta(rng.randrange(40)), rng.choice([None, *(f"p{i}" for i in range(60))]), rng.choice([None, *map(float, range(9))])) for _ in range(900)]


def windows(events, n):
    out = {}
    for site, day in {(s, d) for s, d, *_ in events}:
        out[site, day] = [e for e in events if e[0] == site and day - timedelta(n - 1) <= e[1] <= day]
    return out


def test_dense_ids_grow_without_gaps(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    ids = M.dense_ids(df.where("day < '2024-01-05'"), "who")
    more = M.dense_ids(df, "who", ids)
    first, all_ = {r.value: r.id for r in ids.collect()}, {r.value: r.id for r in more.collect()}
    assert sorted(first.values()) == list(range(len(first))) and sorted(all_.values()) == list(range(len(all_)))
    assert first.items() <= all_.items() and set(all_) == {e[2] for e in events} - {None}
    assert M.dense_ids(df, "who", more).count() == len(all_)
    one = M.dense_ids(df.where("who = 'p1'"), "who")
    assert sorted(r.id for r in M.dense_ids(df.where("who in ('p1', 'p2')"), "who", one).collect()) == [0, 1]
    assert M.dense_ids(df.where("false"), "who", M.dense_ids(df.where("false"), "who")).count() == 0


def test_trailing_distinct(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    # ids far apart lie in different buckets
    ids = M.dense_ids(df, "who").withColumn("id", F.col("id") * 40_000)
    daily = M.daily_bitmaps(df, ["site"], "day", "who", ids)
    got = {(r.site, r.day): (r.distinct_1d, r.distinct_7d, r.distinct_28d) for r in M.trailing_distinct(daily, ["site"], [1, 7, 28]).collect()}
    want = {k: tuple(len({e[2] for e in w[k] if e[2]}) for w in (windows(events, 1), windows(events, 7), windows(events, 28))) for k in windows(events, 1)}
    assert got == {k: v for k, v in want.items() if v[0]}
    whole = {r.site: r["values"] for r in M.distinct_counts(daily, ["site"]).collect()}
    assert whole == {s: len({e[2] for e in events if e[0] == s and e[2]}) for s in ("a", "b", None)}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_are_exact_on_whole_numbers(spark, events, q):
    hist = M.daily_histogram(spark.createDataFrame(events, SCHEMA), ["site"], "day", F.col("x"))
    got = {r.site: r.v for r in M.quantile_of(hist, ["site"], q, "v").collect()}
    for s, v in got.items():
        assert v == pytest.approx(np.quantile([e[3] for e in events if e[0] == s and e[3] is not None], q))


def test_trailing_medians(spark, events):
    hist = M.daily_histogram(spark.createDataFrame(events, SCHEMA), ["site"], "day", F.col("x"))
    got = {(r.site, r.day): (r.q_3d, r.q_14d) for r in M.trailing_quantile(hist, ["site"], [3, 14]).collect()}
    plain = lambda n: {k: [e[3] for e in w if e[3] is not None] for k, w in windows([e for e in events if e[3] is not None], n).items()}
    three, fourteen = plain(3), plain(14)
    assert got == {k: (statistics.median(three[k]), statistics.median(fourteen[k])) for k in three}


def test_rounded_values_keep_the_stated_error(spark):
    rng = random.Random(2)
    rows = [("a", DAY, None, rng.lognormvariate(0, 1)) for _ in range(2000)]
    for q in (0.1, 0.5, 0.99):
        got = M.quantile_of(M.daily_histogram(spark.createDataFrame(rows, SCHEMA), ["site"], "day", F.col("x"), 0.05), ["site"], q).first().quantile
        assert abs(got - np.quantile([r[3] for r in rows], q)) <= 0.0251


def test_several_distinct_counts_do_not_expand_rows(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    out = T.conditional(df, ["site"], counts={"n": F.lit(True)}, distinct={"who": F.col("who"), "days": F.col("day")}, means={"m": F.col("x")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "NestedLoop" not in plan and out.columns == ["site", "n", "who", "days", "m"]
    got = {r.site: (r.n, r.who, r.days) for r in out.collect()}
    assert got == {s: (len(e), len({x[2] for x in e} - {None}), len({x[1] for x in e})) for s in ("a", "b", None) for e in [[x for x in events if x[0] == s]]}
