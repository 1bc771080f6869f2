"""Sources, sinks and the incremental ingest on fresh folders."""

import json
import tracemalloc
import uuid
from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from funnelspark.plans import catalog, catalog_sources
from funnelspark.sinks import tables as W
from funnelspark.sources import json_pages as J
from funnelspark.sources import json_values as V
from funnelspark.sources import tables as S
from funnelspark.streaming import ingest as R


def name():
    return "t_" + uuid.uuid4().hex[:10]


def test_pages_take_the_date_from_the_path(spark, tmp_path):
    for day, ids in (("2024-01-01", [1, 2]), ("2024-01-02", [3])):
        folder = tmp_path / "leads" / day / "run1"
        folder.mkdir(parents=True)
        body = {"result": {"data": [{"id": i, "Modified Time": "x"} for i in ids]}}
        (folder / "page_1.json").write_text(json.dumps(body, indent=2))
    df = J.read_pages(spark, f"{tmp_path}/leads/*/*/page_*.json", "result.data")
    assert sorted((r.snapshot_date, r.id) for r in df.collect()) == [(date(2024, 1, 1), 1), (date(2024, 1, 1), 2), (date(2024, 1, 2), 3)]
    assert "Modified_Time" in S.sanitise_columns(df).columns


def test_roots_skip_the_missing_and_fail_when_none(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"id": 1}')
    df, skipped = J.read_roots(spark, {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"})
    assert df.count() == 1 and [n for n, _ in skipped] == ["b"]
    with pytest.raises(RuntimeError):
        J.read_roots(spark, {"b": f"{tmp_path}/b"})


def test_roots_that_cannot_be_read_are_no_missing_roots(spark, tmp_path):
    for root in ("a", "b"):
        (tmp_path / root).mkdir()
        (tmp_path / root / "x.json").write_text('{"id": 1}')
    (tmp_path / "b" / "y.json.gz").write_bytes(b"no gzip at all")
    there = {"a": f"{tmp_path}/a"}
    with pytest.raises(Exception, match="(?i)gzip|y.json.gz"):  # its schema cannot be told
        J.read_roots(spark, {**there, "b": f"{tmp_path}/b"})
    with pytest.raises(Exception, match="nosuchstore"):  # neither there nor missing: the store does not answer
        J.read_roots(spark, {**there, "b": "nosuchstore://host/b"}, "id bigint")
    with pytest.raises(RuntimeError, match="'c'"):
        J.read_roots(spark, {**there, "c": f"{tmp_path}/c"}, "id bigint", required=("a", "c"))
    df, skipped = J.read_roots(spark, {**there, "c": f"{tmp_path}/c"}, "id bigint", required=("a",))
    assert [(r.id, r["_root"]) for r in df.collect()] == [(1, "a")] and [n for n, _ in skipped] == ["c"]


def test_newest_file_per_day_with_high_water_mark(spark, tmp_path):
    for f in ("census_20240101_010101.json", "census_20240101_230000.json", "census_20240102_010101.json"):
        (tmp_path / f).write_text('{"id": 1}')
    files = J.list_files(spark, str(tmp_path))
    loaded = spark.createDataFrame([("s", date(2024, 1, 1))], "source string, last_day date")
    all_days = J.newest_per_day(files, F.lit("s"), r"census_(\d{8})_")
    later = J.newest_per_day(files, F.lit("s"), r"census_(\d{8})_", loaded)
    assert sorted(r.path.rsplit("/", 1)[1] for r in all_days.collect()) == ["census_20240101_230000.json", "census_20240102_010101.json"]
    assert [r.day for r in later.collect()] == [date(2024, 1, 2)]


def test_every_value_of_every_file_is_read(spark, tmp_path):
    page = lambda *ids: json.dumps({"result": {"data": [{"id": i} for i in ids]}})
    files = {"whole": json.dumps(json.loads(page(1, 2)), indent=1), "lines": page(3) + "\n" + page(4, 5) + "\n", "array": "[" + page(6) + "," + page(7) + "]", "empty": "", "cut": page(8, 9)[:25], "half": page(10) + "\n" + page(11)[:20]}
    folder = tmp_path / "2024-01-01"
    folder.mkdir()
    for name_, text in files.items():
        (folder / f"{name_}.json").write_text(text)
    schema = "result struct<data: array<struct<id: bigint>>>"
    with pytest.raises(Exception, match="unreadable JSON"):
        J.read_pages(spark, str(folder), "result.data", schema).collect()
    good = J.read_pages(spark, str(folder), "result.data", schema, on_bad="skip")
    assert sorted(r.id for r in good.collect()) == [1, 2, 3, 4, 5, 6, 7, 10]
    bad = {r.path.rsplit("/", 1)[1]: r["values"] for r in J.unreadable(spark, str(folder), schema).collect()}
    assert bad == {"cut.json": 1, "half.json": 1}


SHAPES = {
    "indented": (' {"id":1}\n {"id":2}', [1, 2], 0),
    "on_a_line": ('{"id":3}{"id":4} {"id":5}\n', [3, 4, 5], 0),
    "element_a_line": ('[\n{"id":6},\n{"id":7}\n]\n', [6, 7], 0),
    "pretty": (json.dumps([{"id": 8, "x": {"y": [1, "}{"]}}, {"id": 9}], indent=2), [8, 9], 0),
    "pretty_objects": (json.dumps({"id": 10}, indent=1) + "\n" + json.dumps({"id": 11}, indent=1), [10, 11], 0),
    "strings": ('{"id":12,"x":"a\\"}{[\\\\"}\r\n{"id":13,"x":"]"}', [12, 13], 0),
    "garbage": ('{"id":14} oops\n{"id":15}', [14, 15], 1),
    "cut_lines": ('{"id":16}\n{"id":17,"x":{"a":[\n{"id":18}\n{"id":19}\n{"id":\n{"id":20}', [16, 18, 19, 20], 2),
    "cut_array": ('[{"id":21},\n{"id":22},\n{"id":2', [21, 22], 2),
    "cut_pretty": (json.dumps({"id": 23, "x": [{"id": 99}, {"id": 98}]}, indent=1)[:-6], [], 1),
    "empty": ("", [], 0), "blank": ("\n \n", [], 0), "nothing": ("[]", [], 0), "marked": ('\ufeff{"id":24}', [24], 0), "scalar": ('7\n{"id":25}', [25], 1),
    "two_arrays": ('[{"id":26}]\n[{"id":27},{"id":28}]', [26, 27, 28], 0),
}


@pytest.mark.parametrize("split", [False, True])
def test_values_and_lines_in_any_shape(spark, tmp_path, split):
    """Every shape, with files in one split and with every file cut into splits of a few bytes."""
    for n, (text, _, _) in SHAPES.items():
        (tmp_path / f"{n}.json").write_bytes(text.encode())
    conf = {"spark.sql.files.maxPartitionBytes": "16", "spark.sql.files.openCostInBytes": "1"} if split else {}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = J._values(spark, str(tmp_path), "id bigint").collect()
        letters = J.dead_letters(spark, str(tmp_path), "id bigint").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got, bad = {n: [] for n in SHAPES}, dict.fromkeys(SHAPES, 0)
    for r in rows:
        n = r.path.rsplit("/", 1)[1][: -len(".json")]
        if r.bad is None:
            got[n].append(r.value.id)
        else:
            bad[n] += 1
    assert {n: sorted(v) for n, v in got.items()} == {n: v[1] for n, v in SHAPES.items()}
    assert {n for n, v in bad.items() if v} == {n for n, v in SHAPES.items() if v[2]}
    assert letters == sum(bad.values())
    if not split:
        assert bad == {n: v[2] for n, v in SHAPES.items()}


def test_large_line_file_is_read_by_many_tasks(spark, tmp_path):
    with open(tmp_path / "a.json", "w") as f:
        f.writelines(f'{{"id":{i},"x":"{"y" * 80}"}}\n' if i % 1000 else '{"id":\n' for i in range(120_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        values = J._values(spark, str(tmp_path), "id bigint, x string")
        assert values.rdd.getNumPartitions() > 5
        assert values.groupBy(F.col("bad").isNull().alias("good")).count().orderBy("good").collect() == [(False, 120), (True, 119_880)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("whole", [False, True])
def test_a_batch_of_long_lines_is_not_held_as_objects(whole):
    """40 MB of lines in one batch: what is held and what a batch of values has does not follow it."""
    line = '{"x":"' + "y" * 200_000 + '"}'
    batch = pa.RecordBatch.from_arrays([pa.array(["p"] * 200), pa.array([line] * 200), pa.array([whole] * 200)], names=["path", "value", "whole"])
    tracemalloc.start()
    try:
        sizes, n = [], 0
        for out in V._split(iter([batch])):
            assert set(out.column("text").unique().to_pylist()) <= {line}
            sizes.append(out.nbytes)
            n += out.num_rows
        split = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        counts = [r for out in V._count(iter([batch.select(["path", "value"])])) for r in out.to_pylist()]
        count = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 200 and max(sizes) < 5_000_000 and counts == [{"path": "p", "alone": 200}]
    assert split < 10_000_000 and count < 10_000_000


def test_schema_of_all_values(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1}{"id":2,"later":"x"}\n{"id":')
    df = J.infer_schema(spark, str(tmp_path))
    assert df.simpleString() == "struct<id:bigint,later:string>"


def test_all_files_of_the_newest_drop(spark, tmp_path):
    for f in ("census_20240101_010101/a.json", "census_20240101_230000/a.json", "census_20240101_230000/b.json"):
        (tmp_path / f).parent.mkdir(exist_ok=True)
        (tmp_path / f).write_text('{"id": 1}\n{"id": 2}')
    chosen = J.newest_per_day(J.list_files(spark, str(tmp_path)), F.lit("s"), r"census_(\d{8})_", drop_pattern=r"census_(\d{8}_\d{6})")
    assert chosen.count() == 2
    assert sorted(r.id for r in J.read_selected(spark, chosen, "id int").collect()) == [1, 1, 2, 2]
    assert J.read_selected(spark, chosen.where("false"), "id int").count() == 0


def test_sanitise_collisions(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("A b", "a;b", "(x)")
    assert S.sanitise_columns(df).columns == ["A_b", "a_b_1", "x"]


def test_sheet_missing_required(spark):
    df = spark.createDataFrame([("1",)], "mr string")
    with pytest.raises(ValueError):
        S.normalise_sheet(df, {"d": {"is": ["Date"]}}, source_file="f", source_type="w", required=["d"])


def test_column_or_null_and_detect(spark):
    df = spark.createDataFrame([(1,)], "Id int")
    assert df.select(S.column_or_null(df, "ID", "int").alias("a"), S.column_or_null(df, "no").alias("b")).first() == (1, None)
    assert S.detect_column(df, ["x", "Id"]) == "Id"
    assert S.detect_column(df, ["x"], required=False) is None
    with pytest.raises(ValueError):
        S.detect_column(df, ["x"])


def _rows(spark, table, *cols):
    return sorted(tuple(r) for r in spark.table(table).select(*cols).collect())


def test_merge_is_null_safe_keeps_vanished_and_floors(spark, tmp_path):
    t = name()
    base = spark.createDataFrame([(1, "w1", None, 10), (2, "w1", "b", 20), (3, "w2", "c", 30)], "n int, week string, k string, v int").drop("n")
    W.overwrite(base, t, ["week"], f"{tmp_path}/t")
    up = spark.createDataFrame([("w1", None, 11), ("w3", "d", 40), ("w0", "z", 1)], "week string, k string, v int")
    for _ in range(2):  # a repeated run changes nothing
        W.merge(up, t, ["week", "k"], "week", floor="w1")
        assert _rows(spark, t, "week", "v") == [("w1", 11), ("w1", 20), ("w2", 30), ("w3", 40)]
    W.merge(up.where("week = 'w1'"), t, ["week", "k"], "week", replace_window=True)
    assert _rows(spark, t, "week", "v") == [("w1", 11), ("w2", 30), ("w3", 40)]
    with pytest.raises(ValueError):
        W.merge(up, t, ["k"], "week")


@pytest.mark.parametrize("write", ["merge", "upsert"])
def test_null_partition_and_new_columns_keep_every_row(spark, tmp_path, write):
    t = name()
    base = spark.createDataFrame([("w1", 1, 10, 1), (None, 2, 20, 1), (None, 3, 30, 1)], "week string, k int, v int, pulled int")
    W.overwrite(base, t, ["week"], f"{tmp_path}/t")
    up = spark.createDataFrame([(None, 2, 21, 2, "x")], "week string, k int, v int, pulled int, extra string")

    def run(df):
        W.merge(df, t, ["week", "k"], "week") if write == "merge" else W.upsert_newest(df, t, ["week", "k"], "pulled", "week")

    for _ in range(2):
        run(up)
        assert sorted(map(str, _rows_any(spark, t, "k", "v", "extra"))) == ["(1, 10, None)", "(2, 21, 'x')", "(3, 30, None)"]
    run(up.drop("v", "extra").withColumn("pulled", F.lit(3)))
    assert sorted(map(str, _rows_any(spark, t, "k", "v", "extra"))) == ["(1, 10, None)", "(2, None, None)", "(3, 30, None)"]


def _rows_any(spark, table, *cols):
    return [tuple(r) for r in spark.table(table).select(*cols).collect()]


def test_merge_refuses_two_updates_of_a_key(spark, tmp_path):
    t = name()
    W.overwrite(spark.createDataFrame([("w1", 1, 10)], "week string, k int, v int"), t, ["week"], f"{tmp_path}/t")
    with pytest.raises(ValueError, match="several updates"):
        W.merge(spark.createDataFrame([("w1", 2, 1), ("w1", 2, 2)], "week string, k int, v int"), t, ["week", "k"], "week")
    assert _rows(spark, t, "k", "v") == [(1, 10)]


def test_swap_is_mended_after_a_crash(spark, tmp_path):
    t = name()
    one = spark.createDataFrame([("w1", 1)], "week string, v int")
    W.swap(one, t, ["week"], f"{tmp_path}/t")
    W.swap(one.withColumn("v", F.lit(2)), t, ["week"], f"{tmp_path}/t")
    assert _rows(spark, t, "v") == [(2,)] and len([p for p in tmp_path.iterdir() if p.name.startswith("t__")]) == 1
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__old")
    W.swap(one.withColumn("v", F.lit(3)), t, ["week"], f"{tmp_path}/t")
    assert _rows(spark, t, "v") == [(3,)] and not spark.catalog.tableExists(f"{t}__old")


def test_range_with_a_quote_in_a_label(spark, tmp_path):
    t = name()
    W.overwrite(spark.createDataFrame([("a'1", 1), ("a'2", 2)], "d string, v int"), t, ["d"], f"{tmp_path}/t")
    W.replace_range(spark.createDataFrame([("a'2", 5)], "d string, v int"), t, "d", "a", "b")
    assert _rows(spark, t, "d", "v") == [("a'2", 5)]


def test_replace_range_drops_empty_days(spark, tmp_path):
    t = name()
    W.overwrite(spark.createDataFrame([("d1", 1), ("d2", 2), ("d3", 3)], "d string, v int"), t, ["d"], f"{tmp_path}/t")
    W.replace_range(spark.createDataFrame([("d2", 20), ("d9", 9)], "d string, v int"), t, "d", "d2", "d3")
    assert _rows(spark, t, "d", "v") == [("d1", 1), ("d2", 20)]


def test_replace_partition_rebuilds_on_new_column(spark, tmp_path):
    t = name()
    W.overwrite(spark.createDataFrame([("w1", 1), ("w2", 2)], "week string, v int"), t, ["week"], f"{tmp_path}/t")
    W.replace_partition(spark.createDataFrame([("w2", 5, "x")], "week string, v int, extra string"), t, "week", f"{tmp_path}/t")
    assert sorted(spark.table(t).select("week", "v", "extra").collect(), key=str) == [("w1", 1, None), ("w2", 5, "x")]


def test_stream_newest_copy_wins_in_any_order(spark, tmp_path):
    src, t = tmp_path / "in", name()
    src.mkdir()
    schema = "id int, day string, v string, at int"

    def drop(file, *recs):
        (src / file).write_text("\n".join(json.dumps(r) for r in recs))

    def run():
        stream = spark.readStream.schema(schema).json(str(src))
        R.ingest_available(stream, t, f"{tmp_path}/cp", ["id", "day"], "at", "day", path=f"{tmp_path}/t").awaitTermination()
        return _rows(spark, t, "id", "v")

    drop("1.json", {"id": 1, "day": "d1", "v": "new", "at": 5}, {"id": 2, "day": "d1", "v": "b", "at": 1})
    assert run() == [(1, "new"), (2, "b")]
    drop("2.json", {"id": 1, "day": "d1", "v": "late", "at": 4}, {"id": 2, "day": "d1", "v": "c", "at": 2}, {"id": 3, "day": "d2", "v": "x", "at": 1})
    assert run() == [(1, "new"), (2, "c"), (3, "x")]
    assert run() == [(1, "new"), (2, "c"), (3, "x")]


def test_json_stream_keeps_rejects_and_replays(spark, tmp_path):
    """Several values a file, broken ones, a second delivery of the first batch, files that come later."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n in ("indented", "on_a_line", "element_a_line", "garbage", "cut_lines"):
        (folder / f"{n}.json").write_bytes(SHAPES[n][0].encode())
    rows, rejects = f"{tmp_path}/rows", f"{tmp_path}/rejects"

    def run(first=False):
        lines = R.json_lines(spark, str(folder), files_per_batch=2)
        R.ingest_json(lines, "id bigint", rows, rejects, f"{tmp_path}/checkpoint", lambda df: df.select("id"), redeliver_first=first).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(rows).collect()), spark.read.parquet(rejects).count()

    want = [*range(1, 8), 14, 15, 16, 18, 19, 20], 3
    assert run(True) == want
    assert run() == want
    (folder / "later.json").write_text('[{"id":30}]\n{"id":')
    assert run() == ([*want[0], 30], 4)


def test_json_stream_query_takes_a_share_of_the_files(spark, tmp_path, monkeypatch):
    """80 files are eight batches, not one for every seven of them."""
    keys = (F.floor(F.col("id") / 2) * 300 + F.col("id") % 2).alias("o_orderkey")
    orders = spark.range(160).select(keys, (F.col("id") + 0.5).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(f"{tmp_path}/data/orders.parquet")
    monkeypatch.setattr(catalog_sources, "scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    got = {r["shape"]: (r["n"], r["total"], r["bad"]) for r in catalog.queries()["r1_json_stream"](spark, f"{tmp_path}/data").collect()}
    totals = [sum(i + 0.5 for i in range(160) if i // 2 % 4 == s) for s in range(4)]
    assert got == {s: (40, totals[s], 4) for s in range(4)}
    assert len([*(tmp_path / "r1-rows").glob("batch_id=*")]) == 8
