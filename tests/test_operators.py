"""Table operators against brute force and hand-made cases."""

import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import calls as C
from funnelspark.operators import census as S
from funnelspark.operators import dedupe as D
from funnelspark.operators import history as H
from funnelspark.operators import linking as L
from funnelspark.operators import mapping as M
from funnelspark.operators import measures as T
from funnelspark.operators import quality as Q
from funnelspark.operators import scoring as P
from funnelspark.operators.finance import weekly_targets
from funnelspark.operators.funnel import align_stages, funnel
from funnelspark.operators import intervals
from funnelspark.operators.intervals import first_in_window, nearest_by_day, reverse_link


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- dedupe ----


def test_latest_nulls_last_and_tie(frame):
    df = frame([(1, None, 5), (1, 3, 9), (1, 3, 8), (2, None, 1)], "k int, m int, id int")
    one = D.latest(df, ["k"], ["m"], ["id"])
    assert rows(one, "k") == [(1, 3, 8), (2, None, 1)]
    assert rows(D.latest(one, ["k"], ["m"], ["id"]), "k") == rows(one, "k")


def test_keep_one_limits_rows_before_the_shuffle(spark, frame):
    df = frame([(1, 2)], "k int, m int")
    plan = D.latest(df, ["k"], ["m"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_newest_pull_is_idempotent(frame):
    old = frame([(1, 1, "a"), (2, 1, "b")], "k int, at int, v string")
    new = frame([(1, 2, "c"), (2, 0, "d"), (3, 1, "e")], "k int, at int, v string")
    once = D.newest_pull(old, new, ["k"], "at")
    assert rows(once, "k") == [(1, 2, "c"), (2, 1, "b"), (3, 1, "e")]
    assert rows(D.newest_pull(once, new, ["k"], "at"), "k") == rows(once, "k")


def test_flag_duplicates_with_null_keys(frame):
    df = frame([("a", None, "f1"), ("a", None, "f2"), ("b", 1, "f1")], "k string, d int, f string")
    assert rows(D.flag_duplicates(df, ["k", "d"], "f"), "f", "k") == [
        ("a", None, "f1", True, "f1 | f2"), ("b", 1, "f1", False, None), ("a", None, "f2", True, "f1 | f2"),
    ]


def test_new_keys_null_safe(frame):
    df = frame([(1, "a"), (None, "a"), (None, "b")], "k int, s string")
    seen = frame([(None, "a")], "k int, s string")
    assert rows(D.new_keys(df, seen, ["k", "s"]), "s", "k") == [(1, "a"), (None, "b")]


def test_canonical_members_one_row_per_id(frame):
    df = frame([("ann", "1")] * 3 + [("ann", "2")] + [("bob", "2")] * 2, "name string, id string")
    got = rows(D.canonical_members(df, "name", "id"), "id")
    assert got == [("1", "1", "ann"), ("2", "2", "bob")]
    assert rows(D.merged_members(df, "name", "id"), "name") == [("ann", 2, 4)]


# ---- history ----


def _snapshots(frame):
    d = [date(2024, 1, i) for i in range(1, 6)]
    data = [
        (1, d[0], 1, "A"), (1, d[1], 1, "A"), (1, d[2], 2, "B"), (1, d[2], 1, "Z"), (1, d[3], 3, "A"),
        (2, d[0], 1, None), (2, d[1], 1, ""), (3, d[4], 1, "x"),
    ]
    return frame(data, "id int, snap date, mod int, v string").withColumn("nested", F.array("v"))


def test_scd2(frame):
    hist, cur = H.scd2(_snapshots(frame), "id", "snap", "mod")
    got = rows(hist.select("id", "version", "valid_from", "valid_to", "v"), "id", "version")
    d = lambda i: date(2024, 1, i)
    assert got == [
        (1, 1, d(1), d(2), "A"), (1, 2, d(3), d(3), "B"), (1, 3, d(4), None, "A"),
        (2, 1, d(1), d(1), None), (2, 2, d(2), None, ""), (3, 1, d(5), None, "x"),
    ]
    assert rows(cur.select("id", "v"), "id") == [(1, "A"), (2, ""), (3, "x")]
    compat, _ = H.scd2(_snapshots(frame), "id", "snap", "mod", compat_hash=True)
    assert compat.where("id = 2").count() == 1


def test_scd2_intervals_do_not_overlap(frame):
    rng = random.Random(3)
    data = [(k, date(2024, 1, 1) + timedelta(days=n), rng.randrange(3), rng.choice("AB")) for k in range(5) for n in rng.sample(range(60), 30)]
    hist, _ = H.scd2(frame(data, "id int, snap date, mod int, v string"), "id", "snap", "mod")
    by_id = {}
    for r in hist.orderBy("id", "valid_from").collect():
        by_id.setdefault(r.id, []).append(r)
    for versions in by_id.values():
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to == b.valid_from - timedelta(days=1) and a.v != b.v
        assert versions[-1].valid_to is None


# ---- time-windowed matching ----


def _events(seed, n, hot):
    rng = random.Random(seed)
    key = lambda: rng.choice([hot] * 3 + ["b", "c", "d", None])
    base = [(i, key(), rng.choice([None] + [rng.randrange(0, 3000)] * 20)) for i in range(n)]
    events = [(1000 + i, key(), rng.randrange(0, 3000)) for i in range(n)]
    return base, events


@pytest.mark.parametrize("after,until,closed,width", [(0, 400, False, 100), (0, 400, True, 7), (-500, 0, True, 64), (10, 5000, False, 10**6)])
def test_first_in_window_equals_brute_force(frame, monkeypatch, after, until, closed, width):
    monkeypatch.setattr(intervals, "_SPAN", width)
    base, events = _events(after + until, 250, "a")
    b = frame(base, "id int, k string, t int")
    e = frame(events, "eid int, k2 string, t2 int")
    got = first_in_window(
        b, e, base_key="k", base_time=F.col("t"), event_key="k2", event_time=F.col("t2"), event_id="eid", carry=["k2"],
        after=after, until=until, include_start=closed,
    )
    expect = []
    for i, k, t in base:
        hits = [(t2, eid) for eid, k2, t2 in events
                if k is not None and k == k2 and t is not None and (t2 >= t + after if closed else t2 > t + after) and t2 <= t + until]
        expect.append((i, min(hits)[1] if hits else None))
    assert rows(got.select("id", "match.id"), "id") == expect
    assert got.count() == b.count()


def test_first_in_window_holds_no_crowd_in_a_group(spark):
    """One key with 200,000 calls inside 20 seconds: window groups hold one row per second and side, answers stay exact."""
    calls = spark.range(200_000).select("id", F.lit("hot").alias("k"), (F.col("id") % 20).alias("t"))
    starts = calls.select(F.col("k").alias("_key"), F.col("t").alias("_t"))
    events = calls.where("id % 2 = 0").select(F.col("k").alias("_key"), F.col("t").alias("_t"), F.struct("t", "id").alias("_event"))
    found = rows(intervals.first_lookup(starts, events, length=5), "_t")
    assert [(t, tuple(e)) for _, t, e in found] == [(t, (t + 2 - t % 2, t + 2 - t % 2)) for t in range(18)]
    got = first_in_window(
        calls, calls.where("id % 2 = 0"), base_key="k", base_time=F.col("t"), event_key="k", event_time=F.col("t"), event_id="id", until=5
    )
    counts = rows(got.groupBy("t", F.col("match.id").alias("hit")).count(), "t")
    assert counts == [(t, t + 2 - t % 2 if t < 18 else None, 10_000) for t in range(20)]


def test_first_in_window_clashing_names_and_missing_values(frame):
    base = frame([(1, None, 5, "x"), (2, "a", None, "y"), (3, "a", 5, "z"), (3, "a", 5, "z")], "id int, _key string, _t int, _event string")
    events = frame([(9, "a", 7), (8, None, 6), (7, "a", None)], "eid int, k string, t int")
    got = first_in_window(base, events, base_key="_key", base_time=F.col("_t"), event_key="k", event_time=F.col("t"), event_id="eid", until=9)
    assert got.columns == ["id", "_key", "_t", "_event", "match"]
    assert rows(got.select("id", "_event", "match.id"), "id") == [(1, "x", None), (2, "y", None), (3, "z", 9), (3, "z", 9)]
    empty = first_in_window(base.limit(0), events, base_key="_key", base_time=F.col("_t"), event_key="k", event_time=F.col("t"), event_id="eid", until=9)
    assert empty.count() == 0


def test_nearest_by_day_equals_brute_force(frame):
    rng = random.Random(5)
    day = lambda: rng.choice([None] + [date(2024, 1, 1) + timedelta(days=rng.randrange(40))] * 9)
    base = [(i, rng.choice(["a", "a", "b", "z", None]), day()) for i in range(200)]
    cands = [(i, rng.choice(["a", "a", "b", None]), day(), rng.randrange(3)) for i in range(60)]
    got = nearest_by_day(
        frame(base, "id int, k string, d date"), frame(cands, "cid int, ck string, cd date, r int"), base_key="k", base_day=F.col("d"),
        cand_key="ck", cand_day=F.col("cd"), rank=[F.col("r"), F.col("cid")], carry=["cid"],
    )
    expect = []
    for i, k, d in base:
        pool = []
        for cid, ck, cd, r in cands:
            if k is not None and ck == k:
                gap = abs((cd - d).days) if cd and d else None
                pool.append((gap is None, gap or 0, r, cid))
        expect.append((i, min(pool)[3] if pool else None))
    assert rows(got.select("id", "match.cid"), "id") == expect


def test_reverse_link_is_one_to_one(frame):
    events = frame([(1,), (2,)], "eid int")
    matched = frame([(7, 1), (5, 1), (6, None)], "opp int, first_id int")
    assert rows(reverse_link(events, matched, "eid", "first_id", "opp"), "eid") == [(1, 5), (2, None)]


# ---- linking ----


def test_similar_pairs_equal_brute_force(frame):
    from tests.test_functions import _lcs

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12)))
    for t in (67, 73, 80, 81, 86, 88, 90, 100):
        left = [(rng.choice("XY"), word()) for _ in range(120)] + [("X", "aaaaaaaaaaa"), ("X", "ababababab"), (None, "abc"), ("X", None), ("X", "")]
        right = [(rng.choice("XY"), word()) for _ in range(120)]
        right += [(b, w[:-1] + rng.choice("abcd")) for b, w in left if w and len(w) > 3]
        got = L.similar_pairs(frame(left, "b string, n string"), frame(right, "b string, n string"), "b", "n", t)
        expect = set()
        for b, x in set(left):
            for c, y in set(right):
                if b is not None and b == c and x and y and 200.0 * _lcs(x, y) / (len(x) + len(y)) >= t:
                    expect.add((b, x, y))
        assert {(r.block, r.left_name, r.right_name) for r in got.collect()} == expect


@pytest.mark.parametrize("threshold", [80, 88])
def test_scored_pairs_do_not_grow_with_the_block(frame, threshold):
    """Made-up person names, 500 and 8,000 of them in one block: next to none is scored but the name itself and those truly near."""
    rng = random.Random(5)
    parts = ["".join(p) for p in itertools.product("bdfgklmnprstvz", "aeiou", ["", "l", "n", "r", "s"])]
    name = lambda: " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(2, 4))) for _ in range(2))
    for n in (500, 8000):
        df = frame([("X", name()) for _ in range(n)], "b string, n string")
        scored = L.candidate_pairs(df, df, "b", "n", threshold).where("left_name <> right_name").count()
        assert scored < 2 * n


def test_tiered_link_prefers_tier_then_date(frame):
    base = frame([(1, "i1", "n1", date(2024, 1, 10)), (2, None, "n1", date(2024, 1, 10)), (3, None, "zz", None)], "id int, k1 string, k2 string, d date")
    cand = frame(
        [(10, "i1", "n9", date(2020, 1, 1)), (11, None, "n1", date(2024, 1, 8)), (12, None, "n1", date(2024, 1, 12)), (13, None, "n1", date(2024, 1, 11))],
        "cid int, c1 string, c2 string, cd date",
    )
    got = L.tiered_link(
        base, cand, [L.Tier("id", "k1", "c1", "high"), L.Tier("name", "k2", "c2", "low")], base_day=F.col("d"), cand_day=F.col("cd"),
        rank=[F.col("cid")], carry=["cid"],
    )
    assert rows(got.select("id", "cid", "match_method", "match_confidence"), "id") == [
        (1, 10, "id", "high"), (2, 13, "name", "low"), (3, None, "unmatched", "unmatched"),
    ]


# ---- mapping ----


def test_wildcard_map_and_duplicate_rows(frame):
    df = frame([("P", "F", "L"), ("P", "F", None), ("Q", "F", "L"), (None, "F", "L")], "p string, f string, l string")
    m = frame([("P", "F", "L", "exact"), ("P", "F", "L", "later"), ("P", "", "", "wild"), ("NULL", None, None, "none")], "p string, f string, l string, g string")
    out = M.map_with_wildcard(df, m, ["p", "f", "l"], ["p", "f", "l"], "g", "grp")
    assert out.count() == 4
    assert {(r.p, r.l, r.grp) for r in out.collect()} == {("P", "L", "exact"), ("P", None, "wild"), ("Q", "L", "UNMAPPED"), (None, "L", "none")}


def test_canonical_names(frame):
    df = frame([(" ann  LEE",), ("zed",), (" ",), (None,)], "n string")
    m = frame([("Ann Lee", "Ann B. Lee"), ("ann  lee", "Ann B. Lee")], "raw string, canon string")
    assert sorted(str(r.n) for r in M.canonical_names(df, "n", m, "raw", "canon").collect()) == ["Ann B. Lee", "None", "None", "Unknown"]


# ---- calls ----


def test_outcomes(frame):
    data = [
        ("inbound", "answered", 5, 1), ("inbound", "answered", 0, 1), ("inbound", "answered", None, 1), ("inbound", "hangup", None, 9),
        ("inbound", "hangup", None, 10), ("inbound", "busy", None, 0), ("outbound", "busy", None, 0), ("form", "received", None, None), (None, None, None, None),
    ]
    out = C.classify_calls(frame(data, "direction string, status string, talk_time int, ring_time int"))
    assert [r.outcome for r in out.collect()] == [
        "answered", "voicemail", "other", "quick_hangup", "abandoned_on_hold", "missed", "no_contact", "other", "other",
    ]
    assert [r.event_type for r in out.collect()][-2:] == ["form_fill", "other"]


def test_callbacks(frame):
    day = C.DAY
    data = [
        (1, "n", 0, "inbound", "busy", None, 0, "a"), (2, "n", 100, "outbound", "answered", 10, 19, "a"), (3, "n", 899, "outbound", "busy", 0, 30, "b"),
        (4, "m", 0, "inbound", "busy", None, 0, "a"), (5, "m", 7 * day, "outbound", "answered", 40, 0, "a"), (6, "k", 8 * day, "inbound", "busy", None, 0, "a"),
        (7, None, 5, "inbound", "busy", None, 0, "a"),
    ]
    df = C.classify_calls(frame(data, "id int, caller_number string, unix_time long, direction string, status string, talk_time int, ring_time int, agent_id string"))
    out = C.add_callbacks(df, as_of_unix=8 * day + 60)
    got = {r.id: (r.callback_status, r.callback_call_id, r.callback_minutes, r.callback_by_same_agent, r.callback_bucket, r.callback_connected) for r in out.collect()}
    assert len(got) == 7
    assert got[1] == ("called_back", 3, 14, False, "<15min", False)
    assert got[2] == ("no_callback_needed", None, None, None, None, None)
    assert got[4] == ("called_back", 5, 10080, True, "1d-7d", True)
    assert got[6] == ("pending", None, None, None, "pending", None)
    assert got[7] == ("not_called_back", None, None, None, "not_called_back", None)


# ---- funnel ----


def test_funnel_keeps_null_keys_together(frame):
    a = frame([(None, 1), ("x", 1)], "k string, n int")
    b = frame([(None, 1), ("y", 1)], "k string, n int")
    yes = F.lit(True)
    assert rows(funnel({"a": (a, yes), "b": (b, yes)}, ["k"]), "k") == [(None, 1, 1), ("x", 1, 0), ("y", 0, 1)]
    apart = align_stages([a.groupBy("k").agg(F.count("n").alias("a")), b.groupBy("k").agg(F.count("n").alias("b"))], ["k"], ["a", "b"])
    assert apart.where("k is null").count() == 2


# ---- census ----


def test_test_rows_are_three_valued(frame):
    df = frame([(1, "Ann", "Lee"), (2, "Tester", "Lee"), (3, None, "Lee"), (4, "test", "x")], "id int, f string, l string")
    assert [r.id for r in S.drop_test_rows(df, "id", ["f", "l"], [4]).orderBy("id").collect()] == [1, 4]


def test_adc_segments_add_up(frame):
    d = [date(2024, 1, i) for i in range(1, 11)]
    data = [(1, x, "s", "p") for x in d] + [(2, d[0], "s", "q"), (3, d[8], "s", "q"), (4, d[9], "t", "q")]
    df = frame(data, "id int, day date, site string, payor string").withColumn("week", F.next_day("day", "SUN"))
    total = {r.site: r.adc for r in S.average_census(S.weekly_census(df, "week", "day", ["site"]), ["site"]).collect()}
    split = {}
    for r in S.average_census(S.weekly_census(df, "week", "day", ["site"], ["payor"]), ["site", "payor"]).collect():
        split[r.site] = split.get(r.site, 0) + r.adc
    assert split.keys() == total.keys() and all(abs(split[s] - total[s]) < 1e-12 for s in total)
    assert abs(total["s"] - (7 / 6 + 5 / 4) / 2) < 1e-12


def test_backfill_last(frame):
    data = [(1, 1, 10, "x", None), (1, 2, 11, None, "t"), (1, 3, 12, None, None)]
    out = S.backfill_last(frame(data, "k int, day int, id int, a string, b string"), ["k"], "day", ["a", "b"], "id")
    assert [tuple(r) for r in out.select("k", "day", "a", "b").collect()] == [(1, 3, "x", "t")]


# ---- scoring, finance, measures ----


def test_scorecard_adds_other_and_total(frame):
    actual = frame([("A", 2.0), ("A", 2.0), ("Z", 1.0)], "bucket string, points double")
    tgt = frame([("A", 4, 8.0), ("B", 2, 0.0)], "bucket string, admit_target int, point_target double")
    got = {r.bucket: (r.admits, r.admit_pct, r.points, r.point_pct) for r in P.scorecard(actual, tgt).collect()}
    assert got == {"A": (2, "50%", 4.0, "50%"), "B": (0, "0%", 0.0, "—"), "Other": (1, "—", 1.0, "—"), "TOTAL": (3, "50%", 5.0, "63%")}


def test_rules_may_hit_twice_or_never(frame):
    df = frame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    out = P.apply_rules(df, [("first", F.col("v") == "a", 1), ("any", F.col("v").isNotNull(), 2)])
    assert rows(out.select("id", "category", "points"), "id", "category") == [(1, "any", 2.0), (1, "first", 1.0), (2, "any", 2.0)]


def test_weekly_targets_sum_to_budget(frame):
    b = frame([(date(2026, m, d), "E", "Revenue", 100.0 * m) for m, d in ((1, 31), (2, 28), (3, 31))], "month_ending date, entity string, type string, amount double")
    w = weekly_targets(b, "2026-01-04", "2026-03-29")
    sums = {r.month_ending: r.s for r in w.groupBy("month_ending").agg(F.sum("weekly_target").alias("s")).collect()}
    assert all(abs(sums[date(2026, m, d)] - 100.0 * m) < 1e-9 for m, d in ((1, 31), (2, 28), (3, 31)))


def test_rolling_equals_brute_force(frame):
    rng = random.Random(9)
    days = sorted(rng.sample(range(200), 60))
    data = [("k", date(2024, 1, 1) + timedelta(days=n), float(n)) for n in days]
    got = T.rolling(frame(data, "k string, day date, v double"), ["k"], ["v"]).orderBy("day").collect()
    for r, n in zip(got, days):
        assert r["v_28d"] == sum(m for m in days if n - 27 <= m <= n)


def test_previous_period_needs_the_exact_week(frame):
    data = [("k", date(2024, 1, 4), 5), ("k", date(2024, 1, 11), 10), ("k", date(2024, 1, 25), 3)]
    got = rows(T.previous_period(frame(data, "k string, w date, n int"), ["k"], "w", "n").select("w", "n_prev", "n_change"), "w")
    assert got == [(date(2024, 1, 4), None, None), (date(2024, 1, 11), 5, 1.0), (date(2024, 1, 25), None, None)]


def test_ratio_blank(frame):
    df = frame([(1, 0), (1, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(T.ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 0.5]


# ---- quality ----


def test_date_coverage_finds_gaps(frame):
    data = [("a", date(2024, 1, 1))] * 12 + [("a", date(2024, 1, 3))]
    got = rows(Q.date_coverage(frame(data, "k string, d date"), ["k"], "d"), "d")
    assert [(r[2], r[3]) for r in got] == [(12, "ok"), (0, "zero"), (1, "low")]


def test_assert_schema(frame):
    df = frame([(1,)], "a int").withColumn("s", F.struct(F.lit(1).alias("x")))
    assert Q.assert_schema(df, ["x"], struct="s", non_empty=True) is df
    with pytest.raises(ValueError):
        Q.assert_schema(df, ["y"], struct="s")
    with pytest.raises(ValueError):
        Q.assert_schema(df.where("a = 2"), ["a"], non_empty=True)
    with pytest.raises(AssertionError):
        Q.assert_same_count(df, df.where("a = 2"))


def test_null_segments_and_keys_are_counted(frame):
    from datetime import date as d

    from funnelspark.operators import census, quality

    rows = [("w1", d(2024, 1, 1), "s", None), ("w1", d(2024, 1, 2), "s", None), ("w1", d(2024, 1, 1), "s", "p"), ("w1", d(2024, 1, 1), None, "p")]
    weekly = census.weekly_census(frame(rows, "week string, day date, site string, payor string"), "week", "day", ["site"], ["payor"])
    assert sorted((str(r.site), str(r.payor), r.rows, r.adc) for r in weekly.collect()) == [("None", "p", 1, 1.0), ("s", "None", 2, 1.0), ("s", "p", 1, 0.5)]
    days = quality.date_coverage(frame([(None, d(2024, 1, 1)), (None, d(2024, 1, 3)), (None, d(2024, 1, 3))], "k string, day date"), ["k"], "day", low=2)
    assert sorted((r.day.day, r.events, r.status) for r in days.collect()) == [(1, 1, "low"), (2, 0, "zero"), (3, 2, "ok")]


def test_payload_refuses_long_sections(frame):
    df = frame([(i,) for i in range(5)], "n int")
    assert C.payload({"a": df}, most_rows=5).first().body.count("n") == 5
    with pytest.raises(Exception, match="section a has more than 4 rows"):
        C.payload({"a": df}, most_rows=4).collect()


def test_forms_that_nobody_called(frame):
    day, other = date(2024, 1, 1), date(2024, 1, 2)
    calls = frame(
        [
            (1, "n1", 100, "form_fill", "form", day), (2, "n1", 100, "form_fill", "form", day), (3, "n2", 100, "form_fill", "form", day), (4, None, 100, "form_fill", "form", other),
            (5, "n1", 100, "voice", "outbound", day), (6, "n2", 99, "voice", "outbound", day), (7, "n2", 100 + 2 * 86400 + 1, "voice", "outbound", day), (8, "n2", 200, "voice", "inbound", day),
        ],
        "id int, caller_number string, unix_time long, event_type string, direction string, call_date date",
    ).withColumns({c: F.lit("x") for c in ("source", "state", "tracking_label")})
    got = {r.call_date: (r.forms, r.not_called) for r in C.form_status(calls).collect()}
    assert got == {day: (2, 1), other: (1, 1)}
