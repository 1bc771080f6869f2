"""Identity closure and the census frame."""

import random
from datetime import date

from pyspark.sql import functions as F

from funnelspark.operators import identity as I
from funnelspark.operators.census import census_frame


def plain_groups(pairs):
    group = {}
    for a, b in pairs:
        if a is None or b is None:
            continue
        merged = group.get(a, {a}) | group.get(b, {b})
        for x in merged:
            group[x] = merged
    return group


def test_chains_cycles_and_hubs(spark):
    rng = random.Random(1)
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("q", "q"), (None, "a"), ("n", None), ("a", "b")]
    pairs += [(f"k{i:03d}", f"k{i + 1:03d}") for i in range(200)] + [("hub", f"m{i}") for i in range(300)]
    pairs += [(f"r{rng.randrange(300)}", f"r{rng.randrange(300)}") for _ in range(150)]
    rng.shuffle(pairs)
    want = plain_groups(pairs)
    got = I.canonical_ids(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()
    assert {r.id: (r.canonical, r.group_size) for r in got} == {x: (min(g), len(g)) for x, g in want.items()}
    members = spark.createDataFrame([("b", 5), ("c", 3), ("z", 1), ("c", 4)], "id string, n int")
    best = I.canonical_ids(spark.createDataFrame(pairs, "a string, b string"), "a", "b", members, -F.col("n"))
    assert {r.id: r.canonical for r in best.where("id in ('a', 'c', 'x', 'q')").collect()} == {"a": "b", "c": "b", "x": "z", "q": "q"}


def test_labels_do_not_pass_the_driver(spark, monkeypatch):
    """However small the labels are, a round joins them by shuffle."""
    plans, write = [], I.materialise

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(I, "materialise", noted)
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (7, 8)], "a int, b int")
    assert {r.id: r.least for r in I.closed_groups(pairs, "a", "b").collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7}
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)


def test_no_pairs(spark):
    assert I.canonical_ids(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_census_frame_levels_add_up(spark):
    d = lambda n: date(2024, 1, n)
    rows = [("A", s, d(n), d(7), "m1") for s, n in (("x", 1), ("x", 1), ("x", 2), ("y", 2))] + [(None, "x", d(3), d(7), "m1"), ("A", "x", d(9), d(14), "m2"), ("A", None, d(9), d(14), "m2")]
    census = spark.createDataFrame(rows, "site string, seg string, day date, week date, month string")
    budget = spark.createDataFrame([("A", "x", "m1", 4.0), ("A", "x", "m2", 2.0), ("B", "x", "m2", 1.0), ("A", "y", "m0", 9.0)], "site string, seg string, month string, amount double")
    out = census_frame(census, budget, week="week", month="month", day="day", site="site", segment="seg", amount="amount", start="m1", cutoff="m2")
    got = {(r.level, r.site, r.seg): r for r in out.collect()}
    one = got["site and segment", "A", "x"]
    # two weeks: three rows over two dates, one row over one date
    assert (one.actual, one.ytd_actual, one.budget, one.ytd_budget, one.peak_budget) == (1.0, 1.25, 2.0, 3.0, 4.0)
    assert (one.variance, one.variance_pct, one.ytd_variance) == (-1.0, -0.5, -1.75)
    assert got["site and segment", "B", "x"].actual is None and got["site and segment", "B", "x"].variance is None
    assert got["site", "A", None].actual == 2.0 and got["site and segment", "A", None].actual == 1.0
    assert got["site", None, None].ytd_actual == 1.0
    total = got["total", None, None]
    assert (total.actual, total.ytd_actual, total.budget, total.peak_budget) == (2.0, 2.5, 3.0, 9.0)
