"""Version history and latest rows kept up to date batch by batch."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from funnelspark.operators.history import scd2
from funnelspark.streaming import state as S

SCHEMA = "id int, snap date, modified int, status string, nested array<int>"
COLUMNS = ["id", "valid_from", "valid_to", "version", "status", "modified", "row_hash"]


def snapshots(rng, days):
    out = []
    for d in range(days):
        for k in [*range(25), None]:
            for copy in range(1 if rng.random() < 0.8 else 2):
                if rng.random() < 0.7:
                    out.append((k, date(2024, 1, 1) + timedelta(d), d * 10 + copy, rng.choice(["a", "b", None]), [1]))
    return out


def as_set(df):
    return sorted(map(repr, map(tuple, df.select(*COLUMNS).collect())))


@pytest.mark.parametrize("per_batch", [1, 3])
def test_history_by_batches_equals_history_at_once(spark, tmp_path, per_batch):
    rows = snapshots(random.Random(4), 9)
    want = as_set(scd2(spark.createDataFrame(rows, SCHEMA), "id", "snap", "modified")[0])
    store = f"{tmp_path}/store"
    days = sorted({r[1] for r in rows})
    for b, at in enumerate(range(0, len(days), per_batch)):
        drop = spark.createDataFrame([r for r in rows if r[1] in days[at : at + per_batch]], SCHEMA)
        for _ in range(2 if b % 2 else 1):  # delivered twice
            S.apply_snapshots(drop, b, store, "id", "snap", "modified")
    assert as_set(S.version_history(spark, store)) == want
    assert S.batches(spark, f"{store}/state", "upto") == [b - 1, b]


def test_a_batch_reads_the_state_and_not_the_history(spark, tmp_path):
    store, rows = f"{tmp_path}/store", snapshots(random.Random(5), 4)
    for b in range(4):
        S.apply_snapshots(spark.createDataFrame([r for r in rows if r[1] == date(2024, 1, 1 + b)], SCHEMA), b, store, "id", "snap", "modified")
    state = S.state_before(spark, store, 4)
    assert all("/state/upto=3/" in f for f in state.inputFiles())
    assert state.count() == state.select("id").distinct().count()


def test_late_rows_are_kept_apart(spark, tmp_path):
    store = f"{tmp_path}/store"
    drop = lambda *rows: spark.createDataFrame([(k, date(2024, 1, d), d, s, None) for k, d, s in rows], SCHEMA)
    S.apply_snapshots(drop((1, 2, "a"), (2, 2, "a")), 0, store, "id", "snap", "modified")
    S.apply_snapshots(drop((1, 1, "z"), (2, 3, "b"), (3, 1, "n")), 1, store, "id", "snap", "modified")
    late = spark.read.parquet(f"{store}/late/batch_id=1").collect()
    assert [(r.id, r.snap, r.status) for r in late] == [(1, date(2024, 1, 1), "z")]
    got = {(r.id, r.version): (r.valid_from.day, r.valid_to and r.valid_to.day) for r in S.version_history(spark, store).collect()}
    assert got == {(1, 1): (2, None), (2, 1): (2, 2), (2, 2): (3, None), (3, 1): (1, None)}


def test_latest_rows_in_any_order(spark, tmp_path):
    store = f"{tmp_path}/store"
    rows = [[(1, 5, "new"), (2, 1, "x")], [(1, 4, "old"), (2, 2, "y"), (2, 2, "z"), (None, 1, "n")], [(3, 1, "k")]]
    for b, part in enumerate(rows):
        S.apply_latest(spark.createDataFrame(part, "id int, at int, v string"), b, store, ["id"], "at", ["v"])
    S.apply_latest(spark.createDataFrame(rows[-1], "id int, at int, v string"), 2, store, ["id"], "at", ["v"])
    assert sorted((r.id or 0, r.v) for r in S.current_rows(spark, store).collect()) == [(0, "n"), (1, "new"), (2, "y"), (3, "k")]
