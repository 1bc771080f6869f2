"""Queries of the sources, sinks and the incremental ingest.

Files and tables are derived from the sample tables, written to the shared scratch folder, read back with the
operator under test and aggregated, so that the comparison SQL runs on the original tables.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from funnelspark.operators import calls as C
from funnelspark.operators import dedupe as D
from funnelspark.operators import history as H
from funnelspark.operators import quality as Q
from funnelspark.plans import shapes
from funnelspark.plans.registry import query
from funnelspark.session import scratch_dir
from funnelspark.sinks import tables as W
from funnelspark.sources import json_pages as J
from funnelspark.sources import tables as S
from funnelspark.streaming import ingest as R
from funnelspark.streaming import state as K

ORDER_REC = "struct<id:bigint,customer:struct<key:bigint,tier:string>,status:string,total:double,modified:string>"
PAGE_SCHEMA = f"result struct<data: array<{ORDER_REC}>>"
SNAP_DATE = r"snap=(\d{4}-\d{2}-\d{2})/"


def _name(label: str) -> str:
    return f"fs_{label}_{uuid.uuid4().hex[:12]}"


def _records(t):
    return t.orders.select(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.struct(F.col("o_custkey").alias("key"), F.concat(F.lit(" "), F.col("o_orderpriority")).alias("tier")).alias("customer"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.date_format("o_orderdate", "MM-dd-yyyy h:mm a").alias("modified"),
        ).alias("rec"),
        F.floor(F.col("o_orderkey") / 5000).alias("page"),
    )


def _write_pages(t, label: str) -> str:
    """Order records as JSON pages of at most 5,000 records, one page per file, dated folders."""
    path = scratch_dir(t.spark, label)
    pages = _records(t).groupBy("page").agg(F.struct(F.collect_list("rec").alias("data")).alias("result"))
    pages = pages.withColumn("snap", F.date_add(F.lit(date(2024, 1, 1)), (F.col("page") % 30).cast("int"))).drop("page")
    pages.write.partitionBy("snap").option("maxRecordsPerFile", 1).json(path)
    return path


@query(
    "s1_json_pages", "snapshot_date:s status:s n:i total:f",
    sql="""SELECT DATE '2024-01-01' + CAST((o_orderkey // 5000) % 30 AS INTEGER) AS snapshot_date, o_orderstatus AS status, count(*) AS n, sum(o_totalprice) AS total
           FROM orders GROUP BY 1, 2""",
)
def s1(t):
    pages = J.read_pages(t.spark, _write_pages(t, "s1"), "result.data", PAGE_SCHEMA, SNAP_DATE)
    return pages.groupBy("snapshot_date", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))


@query(
    "s2_multi_root", "root:s n:i late:i",
    sql="""SELECT CASE o_orderstatus WHEN 'P' THEN 'rebuild' ELSE 'live' END AS root, count(*) AS n, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS late FROM orders GROUP BY 1""",
)
def s2(t):
    base = scratch_dir(t.spark, "s2")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    # one JSON object per file is what a multi-line reader expects, so a root is written as one array per file
    for root, rows in (("rebuild", o.where("o_orderstatus = 'P'").drop("o_orderpriority")), ("live", o.where("o_orderstatus <> 'P'"))):
        pages = rows.withColumn("page", F.floor(F.col("o_orderkey") / 5000))
        cols = [c for c in rows.columns]
        pages.groupBy("page").agg(F.collect_list(F.struct(*cols)).alias("calls")).drop("page").write.option("maxRecordsPerFile", 1).json(f"{base}/{root}")
    schema = "calls array<struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>>"
    both, _ = J.read_roots(t.spark, {"rebuild": f"{base}/rebuild", "live": f"{base}/live", "gone": f"{base}/gone"}, schema, required=("rebuild", "live"))
    rec = both.select(F.col("_root").alias("root"), F.explode("calls").alias("c"))
    return rec.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.count("c.o_orderpriority").alias("late"))


@query(
    "s3_latest_file_per_day", "source:s day:s n:i",
    sql="""SELECT 'site' || (user_id % 2) AS source, CAST(ts AS DATE) AS day, count(*) AS n FROM events
           WHERE CAST(ts AS DATE) > CASE user_id % 2 WHEN 0 THEN DATE '2024-01-10' ELSE DATE '2023-12-31' END GROUP BY 1, 2""",
)
def s3(t):
    path = scratch_dir(t.spark, "s3")
    e = t.events.select(
        F.expr("'site' || (user_id % 2)").alias("site"), F.date_format("ts", "yyyyMMdd").alias("d"), "event_id", F.explode(F.array(F.lit("060000"), F.lit("180000"))).alias("run")
    )
    # the morning drop is incomplete, the evening drop holds the whole day
    e = e.where((F.col("run") == "180000") | (F.col("event_id") % 2 == 0))
    # a drop is written by several tasks, as several files of several values
    drops = e.groupBy("site", F.concat_ws("_", F.lit("census"), "d", "run").alias("drop"), F.pmod(F.xxhash64("event_id"), F.lit(5)).alias("chunk")).agg(
        F.struct(F.collect_list(F.struct("event_id")).alias("patients")).alias("data")
    )
    drops.repartition("site", F.col("chunk") % 2).drop("chunk").write.partitionBy("site", "drop").json(path)
    files = J.list_files(t.spark, path)
    source = F.regexp_extract("path", r"site=(\w+)/", 1)
    loaded = t.spark.createDataFrame([("site0", date(2024, 1, 10))], "source string, last_day date")
    chosen = J.newest_per_day(files, source, r"census_(\d{8})_", loaded, drop_pattern=r"census_(\d{8}_\d{6})")
    rows = J.read_selected(t.spark, chosen, "data struct<patients: array<struct<event_id: bigint>>>")
    rows = rows.select("path", F.explode("data.patients").alias("p"))
    day = F.to_date(F.regexp_extract("path", r"census_(\d{8})_", 1), "yyyyMMdd")
    return rows.groupBy(F.regexp_extract("path", r"site=(\w+)/", 1).alias("source"), day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s1_unreadable_files", "status:s n:i bad:i",
    sql="SELECT o_orderstatus AS status, count(*) FILTER (WHERE o_orderkey % 50 <> 7) AS n, count(*) FILTER (WHERE o_orderkey % 50 = 7) AS bad FROM orders GROUP BY 1",
)
def s1_unreadable(t):
    """One JSON value a line, one in fifty cut off: the rest is read, the broken ones are counted by file."""
    path = scratch_dir(t.spark, "s1-bad")
    line = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("o_orderkey").alias("id"))).alias("data")).alias("result")))
    o = t.orders.withColumn("line", line)
    value = F.when(F.col("o_orderkey") % 50 == 7, F.substring("line", 1, 12)).otherwise(F.col("line")).alias("value")
    o.select(value, F.col("o_orderstatus").alias("status")).repartition(4, "status").write.partitionBy("status").text(path)
    schema, status = "result struct<data: array<struct<id: bigint>>>", F.regexp_extract("path", "status=(.)", 1).alias("status")
    good = J._checked(J._values(t.spark, path, schema), "skip").select(status, F.explode("value.result.data")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    bad = J.unreadable(t.spark, path, schema).groupBy(status).agg(F.sum("values").alias("bad"))
    return good.join(bad, "status", "left").withColumn("bad", F.coalesce("bad", F.lit(0)))


def _write_shapes(t, label: str) -> str:
    """Orders as JSON files of four shapes (indented lines, several values on a line, an array with an element a line, values over several lines); one file in five ends in a cut-off value."""
    path = scratch_dir(t.spark, label)
    o = t.orders.select(F.floor(F.col("o_orderkey") / 300).alias("page"), F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("tier"))).alias("x"))
    pages = o.groupBy("page").agg(F.collect_list("x").alias("x"))
    shape = F.col("page") % 4
    text = (
        F.when(shape == 0, F.concat_ws("\n", F.transform("x", lambda v: F.concat(F.lit(" "), v)))).when(shape == 1, F.concat_ws("", "x"))
        .when(shape == 2, F.concat(F.lit("[\n"), F.concat_ws(",\n", "x"), F.lit("\n]"))).otherwise(F.replace(F.concat_ws("\n", "x"), F.lit(","), F.lit(",\n ")))
    )
    tail = F.when(F.col("page") % 5 == 0, F.lit("\n" + '{"id":')).otherwise(F.lit(""))
    pages.select(shape.alias("shape"), F.concat(text, tail).alias("value")).write.partitionBy("shape").option("maxRecordsPerFile", 1).text(path)
    return path


_SHAPES_SQL = """SELECT (o_orderkey // 300) % 4 AS shape, count(*) AS n, sum(o_totalprice) AS total, count(DISTINCT CASE WHEN (o_orderkey // 300) % 5 = 0 THEN o_orderkey // 300 END) AS bad
                 FROM orders GROUP BY 1"""
_SHAPE = r"shape=(\d)"


@query("s1_json_shapes", "shape:i n:i total:f bad:i", sql=_SHAPES_SQL)
def s1_shapes(t):
    path, schema = _write_shapes(t, "s1-shapes"), "id bigint, total double, tier string"
    shape = F.regexp_extract("path", _SHAPE, 1).cast("int").alias("shape")
    good = J.read_with_path(t.spark, path, schema, on_bad="skip").groupBy(shape).agg(F.count("id").alias("n"), F.sum("total").alias("total"))
    bad = J.dead_letters(t.spark, path, schema).groupBy(shape).agg(F.count(F.lit(1)).alias("bad"))
    return good.join(bad, "shape", "left").withColumn("bad", F.coalesce("bad", F.lit(0)))


@query(
    "s4_struct_flatten", "id:i customer_key:i tier:s total_int:i",
    sql="SELECT o_orderkey AS id, o_custkey AS customer_key, lower(o_orderpriority) AS tier, CAST(trunc(o_totalprice) AS BIGINT) AS total_int FROM orders",
)
def s4(t):
    return _records(t).select(
        F.col("rec.id").alias("id"), F.col("rec.customer.key").alias("customer_key"), F.lower(F.trim("rec.customer.tier")).alias("tier"),
        F.col("rec.total").cast("bigint").alias("total_int"),
    )


@query("s5_table_scan", "p_brand:s n:i", sql="SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def s5(t):
    name = _name("s5")
    W.overwrite(t.part, name, path=scratch_dir(t.spark, "s5"))
    return S.read_table(t.spark, name).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("s6_schema_assertion", "status:s n:i", sql="SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def s6(t):
    rec = Q.assert_schema(_records(t), ["id", "customer", "status"], struct="rec", non_empty=True)
    return rec.groupBy(F.col("rec.status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s7_column_or_null", "key:i present:s absent:s",
    sql="SELECT n_nationkey AS key, n_name AS present, NULL AS absent FROM nation",
)
def s7(t):
    n = t.nation
    return n.select(
        S.column_or_null(n, "N_NationKey", "int").alias("key"), S.column_or_null(n, "N_NAME").alias("present"), S.column_or_null(n, "n_code").alias("absent")
    )


@query("s8_sanitise_columns", "Full_Name:s full_name_1:s region:i", sql='SELECT n_name AS "Full_Name", lower(n_name) AS "full_name_1", n_regionkey AS region FROM nation')
def s8(t):
    raw = t.nation.select(
        F.col("n_name").alias("Full Name"), F.lower("n_name").alias("full;name="), F.col("n_regionkey").alias("(region)")
    )
    clean = S.sanitise_columns(raw)
    assert clean.columns == ["Full_Name", "full_name_1", "region"], clean.columns
    return clean.toDF("Full_Name", "full_name_1", "region")


@query("s9_drop_nested", "vec_id:i label:i", sql="SELECT vec_id, label FROM embeddings")
def s9(t):
    return H.drop_nested(t.embeddings.withColumn("s", F.struct("label")))


@query("s10_detect_key", "key:s n:i", sql="SELECT 'o_orderkey' AS key, count(DISTINCT o_orderkey) AS n FROM orders")
def s10(t):
    key = S.detect_column(t.orders, ["id", "o_orderkey", "o_custkey"])
    return t.orders.agg(F.count_distinct(key).alias("n")).select(F.lit(key).alias("key"), "n")


_SHEET = {
    "mr_number": {"is": ["MR", "MR Number"]}, "points": {"any": ["points"], "type": "double"}, "segment": {"any": ["segment"], "exclude": ["old"]},
    "channel": {"is": ["Marketing Channel"]},
}


@query(
    "s11_header_normaliser", "mr_number:s points:f segment:s channel:s source_file:s",
    sql="""SELECT CAST(c_custkey AS VARCHAR) AS mr_number, CASE WHEN c_nationkey = 0 THEN 0 ELSE c_acctbal END AS points, c_mktsegment AS segment, NULL AS channel, 'customers.csv' AS source_file FROM customer""",
)
def s11(t):
    path = scratch_dir(t.spark, "s11")
    t.customer.select(
        F.col("c_custkey").alias("mr   NUMBER"), F.lit("z").alias("Old Segment"), F.col("c_mktsegment").alias("Client Segment"),
        F.when(F.col("c_nationkey") == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("Total Points"),
    ).write.option("header", True).csv(path)
    sheet = t.spark.read.option("header", True).csv(path)
    return S.normalise_sheet(sheet, _SHEET, source_file="customers.csv", source_type="weekly", required=["mr_number"])


@query(
    "s12_melt_targets", "month:s category:s value:f",
    sql="""WITH w AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS f, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS o FROM orders GROUP BY 1)
           SELECT month, 'F' AS category, f AS value FROM w WHERE f IS NOT NULL UNION ALL SELECT month, 'O', o FROM w WHERE o IS NOT NULL""",
)
def s12(t):
    wide = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("F"),
        F.sum(F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"), F.col("o_totalprice"))).alias("O"),
        F.sum("o_totalprice").alias("Total"),
    )
    return S.melt(wide, ["month"], ["Total"], "category", "value")


@query(
    "s13_mapping_loader", "program:s location:s grp:s",
    sql="SELECT DISTINCT p_name AS program, CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END AS location, p_brand AS grp FROM part WHERE p_size > 10 AND p_brand <> 'Brand#9' AND p_brand <> 'Brand#7'",
)
def s13(t):
    raw = t.part.select(
        F.concat(F.col("p_name"), F.lit(" ")).alias("program"), F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("location"),
        F.expr("CASE p_brand WHEN 'Brand#9' THEN '⚠️ pick one' WHEN 'Brand#7' THEN '  ' ELSE p_brand END").alias("grp"),
        F.expr("CASE WHEN p_size > 10 THEN '✅ ok' WHEN p_size > 5 THEN '⚠ new' END").alias("status"),
    )
    return S.valid_mapping(raw, ["program", "location"], "grp", "status").distinct()


@query(
    "s14_tab_union", "tab:s n:i cost:f",
    sql="""SELECT l_returnflag AS tab, count(*) AS n, sum(CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_extendedprice END) AS cost FROM lineitem GROUP BY 1""",
)
def s14(t):
    def tab(flag):
        d = t.lineitem.where(F.col("l_returnflag") == flag)
        cost = F.col("l_extendedprice").cast("string")
        return d.select(F.concat(F.lit("$"), cost).alias("cost") if flag == "A" else cost.alias("cost"), "l_suppkey")

    both = S.union_tabs({"R": tab("R"), "A": tab("A").drop("l_suppkey"), "N": tab("N")}, ["cost"])
    return both.groupBy(F.col("_tab").alias("tab")).agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"))


@query("s15_missing_source", "n:i skipped:s", sql="SELECT count(*) AS n, 'other' AS skipped FROM supplier")
def s15(t):
    assert S.read_optional(t.spark, _name("none")) is None
    frames, skipped = S.read_first_available({"supplier": lambda: t.supplier, "other": lambda: t.spark.read.parquet(f"{t.folder}/no_such_table.parquet")})
    return D.union_all(*frames).agg(F.count(F.lit(1)).alias("n")).withColumn("skipped", F.lit("; ".join(n for n, _ in skipped)))


@query(
    "s16_typed_csv", "flag:s n:i amount:f bad:i",
    sql="""SELECT l_returnflag AS flag, count(*) AS n, sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END) AS amount, count(*) FILTER (WHERE l_linestatus <> 'F') AS bad FROM lineitem GROUP BY 1""",
)
def s16(t):
    path = scratch_dir(t.spark, "s16")
    t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice").cast("string")).otherwise(F.lit("pending")).alias("amount"),
    ).write.option("header", True).csv(path)
    rows = S.read_typed_csv(t.spark, path, {"date": "date", "flag": "string", "amount": "double"})
    return rows.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.count_if(F.col("amount").isNull()).alias("bad"))


@query(
    "s17_inline_literals", "label:s n:i",
    sql="SELECT CASE r_name WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'West' ELSE 'Other' END AS label, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
)
def s17(t):
    dim = S.literal_table(t.spark, [("ASIA", "East"), ("EUROPE", "West")], "r_name string, label string")
    d = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return d.join(dim, "r_name", "left").groupBy(F.coalesce("label", F.lit("Other")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("s18_model_table", "facility:s n:i", sql="SELECT facility, count(*) AS n FROM census GROUP BY 1", uses=["census"])
def s18(t):
    name = _name("s18")
    W.overwrite(shapes.census(t), name, path=scratch_dir(t.spark, "s18"))
    return t.spark.table(name).groupBy("facility").agg(F.count(F.lit(1)).alias("n"))


# ---- sinks ---------------------------------------------------------------------------------

_WEEKLY_SQL = "SELECT CAST(o_orderdate AS DATE) + CAST((4 - dayofweek(o_orderdate) + 7) % 7 AS INTEGER) AS week, o_orderpriority AS priority, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2"


def _weekly(t):
    from funnelspark.functions.dates import week_ending

    return t.orders.groupBy(week_ending(F.col("o_orderdate").cast("date")).alias("week"), F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
    )


def _table(t, label: str, df, partition: str | None):
    name = _name(label)
    W.overwrite(df, name, [partition] if partition else [], scratch_dir(t.spark, label))
    return name


LOW, HIGH = date(1998, 1, 1), date(1998, 12, 31)
_IN = "week BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"


def _yearly(t):
    """Weekly counts keyed by a year partition, few enough partitions for a sample table."""
    return _weekly(t).withColumn("year", F.year("week"))


@query("w1_full_overwrite", "week:s priority:s n:i total:f", sql=_WEEKLY_SQL)
def w1(t):
    path, name = scratch_dir(t.spark, "w1"), _name("w1")
    W.overwrite(t.region, name, path=path)
    W.overwrite(_weekly(t), name, path=path)
    return t.spark.table(name)


@query("w2_partitioned_overwrite", "year:i n:i", sql=f"SELECT year(week) AS year, sum(n) AS n FROM ({_WEEKLY_SQL}) GROUP BY 1")
def w2(t):
    name = _table(t, "w2", _yearly(t), "year")
    return t.spark.table(name).groupBy("year").agg(F.sum("n").alias("n"))


@query(
    "w3_replace_partition", "year:i rows:i n:i",
    sql=f"SELECT year(week) AS year, count(*) AS rows, sum(CASE WHEN year(week) = 1998 THEN n * 10 ELSE n END) AS n FROM ({_WEEKLY_SQL}) WHERE year(week) <> 1998 OR priority <> '5-LOW' GROUP BY 1",
)
def w3(t):
    y = _yearly(t)
    name = _table(t, "w3", y, "year")
    new = y.where("year = 1998 and priority <> '5-LOW'").withColumn("n", F.col("n") * 10)
    W.replace_partition(new, name, "year")
    return t.spark.table(name).groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))


@query(
    "w4_replace_range", "month:s n:i",
    sql="""SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(CASE WHEN strftime(o_orderdate, '%Y-%m') BETWEEN '1998-03' AND '1998-05' THEN 2 ELSE 1 END) AS n FROM orders
           WHERE strftime(o_orderdate, '%Y-%m') <> '1998-04' GROUP BY 1""",
)
def w4(t):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    name = _table(t, "w4", m, "month")
    new = m.where("month <> '1998-04'").withColumn("n", F.col("n") * 2)
    W.replace_range(new, name, "month", "1998-03", "1998-05")
    return t.spark.table(name)


@query(
    "w5_merge", "year:i priority:s week:s n:i",
    sql=f"""SELECT year(week) AS year, nullif(priority, '1-URGENT') AS priority, week, CASE WHEN year(week) >= 1999 AND priority IN ('1-URGENT', '2-HIGH') THEN n + 1000 ELSE n END AS n
            FROM ({_WEEKLY_SQL}) UNION ALL SELECT 1999, 'new', week, n FROM ({_WEEKLY_SQL}) WHERE year(week) = 1999 AND priority = '1-URGENT'""",
)
def w5(t):
    y = _yearly(t).drop("total").withColumn("priority", F.expr("nullif(priority, '1-URGENT')"))
    name = _table(t, "w5", y, "year")
    changed = y.where("priority is null or priority = '2-HIGH'").where("year >= 1997").withColumn("n", F.col("n") + 1000)
    added = y.where("year = 1999 and priority is null").withColumn("priority", F.lit("new"))
    W.merge(changed.unionByName(added), name, ["year", "week", "priority"], "year", floor=1999)
    return t.spark.table(name)


@query(
    "w6_upsert_newest", "year:i week:s priority:s n:i pulled:i",
    sql=f"SELECT year(week) AS year, week, priority, CASE WHEN year(week) = 2000 THEN n + 7 ELSE n END AS n, CASE WHEN year(week) = 2000 THEN 2 ELSE 1 END AS pulled FROM ({_WEEKLY_SQL})",
)
def w6(t):
    y = _yearly(t).drop("total").withColumn("pulled", F.lit(1))
    name = _name("w6")
    W.upsert_newest(y, name, ["year", "week", "priority"], "pulled", "year", scratch_dir(t.spark, "w6"))
    again = y.where("year = 2000").withColumns({"n": F.col("n") + 7, "pulled": F.lit(2)})
    stale = y.where("year = 1999").withColumns({"n": F.col("n") - 5, "pulled": F.lit(0)})
    W.upsert_newest(again.unionByName(stale), name, ["year", "week", "priority"], "pulled", "year")
    return t.spark.table(name)


@query("w7_append", "status:s n:i", sql="SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def w7(t):
    name, path = _name("w7"), scratch_dir(t.spark, "w7")
    for s in ("F", "O", "P"):
        W.append(t.orders.where(F.col("o_orderstatus") == s), name, path)
    return t.spark.table(name).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "w8_run_log", "week_label:s status:s admits_total:i points_total:f",
    sql="SELECT 'first' AS week_label, 'ok' AS status, count(*) AS admits_total, sum(o_totalprice) AS points_total FROM orders UNION ALL SELECT 'second', 'warnings', count(*), sum(o_totalprice) FROM orders",
)
def w8(t):
    name, path = _name("w8"), scratch_dir(t.spark, "w8")
    row = t.orders.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("p")).first()
    schema = "week_label string, status string, admits_total long, points_total double"
    for label, status in (("first", "ok"), ("second", "warnings")):
        W.log_run(t.spark, name, {"week_label": label, "status": status, "n": row.n, "p": row.p}, schema, path)
    return t.spark.table(name)


@query(
    "w9_typed_views", "view:s n:i",
    sql="SELECT CASE event_type WHEN 'voice' THEN 'voice_calls' ELSE 'form_fills' END AS view, count(*) AS n FROM classified GROUP BY 1",
    uses=["classified"],
)
def w9(t):
    names = {_name("voice_calls"): "voice", _name("form_fills"): "form_fill"}
    W.typed_views(C.classify_calls(shapes.calls(t)), "event_type", names)
    parts = [t.spark.table(v).agg(F.count(F.lit(1)).alias("n")).withColumn("view", F.lit("_".join(v.split("_")[1:3]))) for v in names]
    return D.union_all(*parts)


@query(
    "w10_dashboard_payload", "section:s body:s",
    sql="""SELECT 'status' AS section, '[' || string_agg('{"o_orderstatus":"' || s || '","n":' || n || '}', ',' ORDER BY s) || ']' AS body FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)
           UNION ALL SELECT 'brands', '[{"brands":' || count(DISTINCT p_brand) || '}]' FROM part""",
)
def w10(t):
    doc = C.payload(
        {"status": t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), "brands": t.part.agg(F.count_distinct("p_brand").alias("brands"))}
    )
    path = scratch_dir(t.spark, "w10")
    W.write_json(doc, path)
    return t.spark.read.schema("section string, body string").json(path)


@query(
    "w11_shared_frame", "grain:s n:i rows:i",
    sql="SELECT 'day' AS grain, count(DISTINCT call_date) AS n, count(*) AS rows FROM calls UNION ALL SELECT 'agent', count(DISTINCT agent_id), count(*) FROM calls",
    uses=["calls"],
)
def w11(t):
    shared = W.shared(shapes.calls(t), "call_date")
    days = shared.agg(F.count_distinct("call_date").alias("n"), F.count(F.lit(1)).alias("rows"))
    agents = shared.agg(F.count_distinct("agent_id").alias("n"), F.count(F.lit(1)).alias("rows"))
    return D.tagged_union({"day": days, "agent": agents}, "grain")


# ---- incremental ingest --------------------------------------------------------------------

_ARRIVAL = "id bigint, day date, value double, ingested_at bigint"


def _arrivals(t, label: str) -> str:
    """Events as arriving JSON files, one in three twice: an older and a newer copy, in two folders."""
    path = scratch_dir(t.spark, label)
    e = t.events.select(F.col("event_id").alias("id"), F.col("ts").cast("date").alias("day"), "value")
    first = e.withColumn("ingested_at", F.lit(1))
    second = e.where(F.col("id") % 3 == 0).withColumns({"value": F.col("value") + 1000, "ingested_at": F.lit(2)})
    for i, part in enumerate((second, first)):
        part.withColumn("batch", F.lit(i)).write.mode("append").partitionBy("batch").json(path)
    return path


_ARRIVAL_SQL = """SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(CASE WHEN event_id % 3 = 0 THEN value + 1000 ELSE value END) AS value,
                  sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END) AS versions FROM events GROUP BY 1"""


def _by_day(df):
    return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"), F.sum("ingested_at").alias("versions"))


@query("r1_incremental_ingest", "day:s n:i value:f versions:i", sql=_ARRIVAL_SQL)
def r1(t):
    path, name = _arrivals(t, "r1"), _name("r1")
    stream = (
        t.spark.readStream.schema(_ARRIVAL).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 4).json(path)
    )
    q = R.ingest_available(
        stream, name, scratch_dir(t.spark, "r1-checkpoint"), ["id", "day"], "ingested_at", "day", path=scratch_dir(t.spark, "r1-table")
    )
    q.awaitTermination()
    return _by_day(t.spark.table(name))


@query("r1_json_stream", "shape:i n:i total:f bad:i", sql=_SHAPES_SQL)
def r1_stream(t):
    """The same files as a stream: rows and rejects go to two tables, some files a batch; the first batch is delivered twice.

    A batch has an eighth of the files that are there, seven at least: its jobs cost about as much for a few files as for many.
    """
    path, rows, rejects = _write_shapes(t, "r1-shapes"), scratch_dir(t.spark, "r1-rows"), scratch_dir(t.spark, "r1-rejects")
    files = J.list_files(t.spark, path).count()
    lines = R.json_lines(t.spark, path, files_per_batch=max(7, -(-files // 8)))
    q = R.ingest_json(lines, "id bigint, total double, tier string", rows, rejects, scratch_dir(t.spark, "r1-lines-checkpoint"), redeliver_first=True)
    q.awaitTermination()
    shape = F.regexp_extract("path", _SHAPE, 1).cast("int").alias("shape")
    good = t.spark.read.parquet(rows).groupBy(shape).agg(F.count("id").alias("n"), F.sum("total").alias("total"))
    bad = t.spark.read.parquet(rejects).groupBy(shape).agg(F.count(F.lit(1)).alias("bad"))
    return good.join(bad, "shape", "left").withColumn("bad", F.coalesce("bad", F.lit(0)))


@query("r2_latest_on_arrival", "day:s n:i value:f versions:i", sql=_ARRIVAL_SQL)
def r2(t):
    path, log = _arrivals(t, "r2"), scratch_dir(t.spark, "r2-log")
    stream = t.spark.readStream.schema(_ARRIVAL).option("recursiveFileLookup", True).json(path)
    R.append_available(stream, log, scratch_dir(t.spark, "r2-checkpoint")).awaitTermination()
    arrived = t.spark.read.schema(_ARRIVAL).parquet(log)
    return _by_day(R.latest_view(arrived, ["id"], "ingested_at"))


_SCD2_SQL = """
  SELECT *, snap AS valid_from, row_number() OVER (PARTITION BY o_custkey ORDER BY snap) AS version, lead(snap) OVER (PARTITION BY o_custkey ORDER BY snap) - 1 AS valid_to
  FROM (SELECT *, lag(status || urgent) OVER (PARTITION BY o_custkey ORDER BY snap) AS prev FROM (
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS snap, o_orderstatus AS status, substr(o_orderpriority, 1, 1) < '4' AS urgent FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1))
  WHERE prev IS NULL OR prev <> status || urgent"""


@query("scd2_on_arrival", "o_custkey:i o_orderkey:i valid_from:s valid_to:s version:i status:s urgent:i", sql=_SCD2_SQL)
def scd2_on_arrival(t):
    """Order snapshots arrive as one drop a year; each updates the open versions and settles those that end."""
    drops, store, checkpoint = (scratch_dir(t.spark, f"scd2-{n}") for n in ("drops", "store", "checkpoint"))
    rows = t.orders.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("snap"), F.col("o_orderstatus").alias("status"), (F.substring("o_orderpriority", 1, 1) < "4").alias("urgent")
    )
    first, last = rows.agg(F.min(F.year("snap")), F.max(F.year("snap"))).first()
    for year in range(first, last + 1):
        rows.where(F.year("snap") == year).write.parquet(f"{drops}/{year}")
        stream = t.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(drops)
        K.on_arrival(stream, checkpoint, lambda df, b: K.apply_snapshots(df, b, store, "o_custkey", "snap", modified="o_orderkey")).awaitTermination()
    return K.version_history(t.spark, store)


@query("r2_latest_state", "day:s n:i value:f versions:i", sql=_ARRIVAL_SQL)
def r2_state(t):
    """The same arrivals, deduplicated as they come: the state holds one row per id, the newest."""
    path, store = _arrivals(t, "r2-state"), scratch_dir(t.spark, "r2-store")
    stream = t.spark.readStream.schema(_ARRIVAL).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 4).json(path)
    K.on_arrival(stream, scratch_dir(t.spark, "r2-state-checkpoint"), lambda df, b: K.apply_latest(df, b, store, ["id"], "ingested_at")).awaitTermination()
    return _by_day(K.current_rows(t.spark, store))
