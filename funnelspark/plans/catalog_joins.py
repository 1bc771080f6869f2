"""Queries of the join operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from funnelspark.operators import calls as C
from funnelspark.operators import mapping as M
from funnelspark.operators.dedupe import canonical_members
from funnelspark.operators.finance import weekly_targets
from funnelspark.operators.funnel import align_on, align_stages, funnel
from funnelspark.operators.intervals import first_in_window, reverse_link
from funnelspark.operators.linking import Tier, block_match, nearest_with_confidence, reasoned_match, similar_pairs, tiered_link
from funnelspark.functions.dates import week_ending
from funnelspark.plans import shapes
from funnelspark.plans.registry import query
from funnelspark.sources.tables import literal_table

WEEK = 7 * 86400


def _touches(t):
    e = t.events.select("event_id", "user_id", "event_type", "value", shapes.epoch_seconds("ts").alias("u"))
    buys = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "u")
    views = e.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), F.col("u").alias("view_u"), F.col("value").alias("view_value")
    )
    return buys, views


def _first_touch(t):
    buys, views = _touches(t)
    return first_in_window(
        buys, views, base_key="user_id", base_time=F.col("u"), event_key="viewer", event_time=F.col("view_u"),
        event_id="view_id", carry=["view_value"], after=-WEEK, until=0, include_start=True,
    ).select("event_id", "user_id", F.col("match.id").alias("view_id"), F.col("match.view_value").alias("view_value"))


_TOUCH_SQL = """
  SELECT b.event_id, b.user_id, v.event_id AS view_id, v.value AS view_value
  FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS u FROM events WHERE event_type = 'purchase') b
  LEFT JOIN (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS u FROM events WHERE event_type = 'view') v
    ON b.user_id = v.user_id AND v.u <= b.u AND v.u >= b.u - 604800
  QUALIFY row_number() OVER (PARTITION BY b.event_id ORDER BY v.u, v.event_id) = 1"""


@query("j1_lookback_first_touch", "event_id:i user_id:i view_id:i view_value:f", sql=_TOUCH_SQL)
def j1(t):
    return _first_touch(t)


@query(
    "j2_followup",
    "id:i callback_status:s callback_call_id:i callback_minutes:i callback_by_agent_id:s callback_by_same_agent:i callback_bucket:s callback_connected:i",
    sql="""SELECT id, callback_status, callback_call_id, callback_minutes, callback_by_agent_id, callback_by_same_agent,
           callback_bucket, callback_connected FROM full_calls""",
    uses=["full_calls"],
)
def j2(t):
    return shapes.full_calls(t)


@query(
    "j3_reverse_link",
    "view_id:i viewer:i matched_event_id:i",
    sql=f"""SELECT e.event_id AS view_id, e.user_id AS viewer, m.matched_event_id FROM events e
            LEFT JOIN (SELECT view_id, min(event_id) AS matched_event_id FROM ({_TOUCH_SQL}) GROUP BY 1) m ON e.event_id = m.view_id
            WHERE e.event_type = 'view'""",
)
def j3(t):
    views = t.events.where(F.col("event_type") == "view").select(F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"))
    touched = _first_touch(t).select("event_id", F.col("view_id").alias("touch_id"))
    return reverse_link(views, touched, "view_id", "touch_id", "event_id")


# Events stand for admissions (dates moved into the range of the orders), orders for opportunities.
_ADMITS_SQL = """
  SELECT event_id AS adm_id, user_id, CAST(ts AS DATE) - 9000 AS day,
         CASE WHEN k < 20 THEN 'C' || user_id END AS id_key, 'N' || user_id || '|' || (k % 4) AS name_dob, 'N' || user_id AS name_key
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""
_OPPS_SQL = """
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'C' || o_custkey END AS o_id, 'N' || o_custkey || '|' || (o_orderkey % 4) AS o_name_dob,
         'N' || o_custkey AS o_name, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS o_day, CAST(o_orderdate AS DATE) AS o_mod
  FROM orders"""


def _admits(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("event_id").alias("adm_id"), "user_id", F.date_sub(F.col("ts").cast("date"), 9000).alias("day"),
        F.when(k < 20, F.expr("'C' || user_id")).alias("id_key"),
        F.concat(F.expr("'N' || user_id || '|'"), (k % 4).cast("string")).alias("name_dob"),
        F.expr("'N' || user_id").alias("name_key"),
    )


def _opps(t):
    return t.orders.select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'C' || o_custkey END").alias("o_id"),
        F.expr("'N' || o_custkey || '|' || (o_orderkey % 4)").alias("o_name_dob"),
        F.expr("'N' || o_custkey").alias("o_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("o_day"),
        F.col("o_orderdate").cast("date").alias("o_mod"),
    )


@query(
    "j4_tiered_linking",
    "adm_id:i o_orderkey:i match_method:s match_confidence:s",
    sql=f"""
      WITH a AS ({_ADMITS_SQL}), o AS ({_OPPS_SQL}),
      l AS (SELECT adm_id, day, o_orderkey, o_day, 1 AS p, 'id_exact' AS m, 'high' AS c FROM a JOIN o ON id_key = o_id
            UNION ALL SELECT adm_id, day, o_orderkey, o_day, 2, 'name_dob', 'high' FROM a JOIN o ON name_dob = o_name_dob
            UNION ALL SELECT adm_id, day, o_orderkey, o_day, 3, 'name_only_proximity', 'low' FROM a JOIN o ON name_key = o_name),
      b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY adm_id ORDER BY p, abs(o_day - day) ASC NULLS LAST, o_orderkey) = 1)
      SELECT a.adm_id, b.o_orderkey, coalesce(b.m, 'unmatched') AS match_method, coalesce(b.c, 'unmatched') AS match_confidence
      FROM a LEFT JOIN b ON a.adm_id = b.adm_id""",
)
def j4(t):
    tiers = [Tier("id_exact", "id_key", "o_id", "high"), Tier("name_dob", "name_dob", "o_name_dob", "high"),
             Tier("name_only_proximity", "name_key", "o_name", "low")]
    return tiered_link(
        _admits(t), _opps(t), tiers, base_day=F.col("day"), cand_day=F.col("o_day"), rank=[F.col("o_orderkey")], carry=["o_orderkey"]
    )


@query(
    "j5_nearest_date",
    "adm_id:i o_orderkey:i match_status:s match_confidence:s",
    sql=f"""
      WITH a AS ({_ADMITS_SQL}), o AS ({_OPPS_SQL})
      SELECT adm_id, o_orderkey, CASE WHEN o_name IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status,
             CASE WHEN o_name IS NULL THEN 'none' WHEN o_day IS NULL THEN 'name_only' WHEN abs(o_day - day) <= 120 THEN 'high' ELSE 'low' END AS match_confidence
      FROM a LEFT JOIN o ON name_dob = o_name_dob
      QUALIFY row_number() OVER (PARTITION BY adm_id ORDER BY abs(o_day - day) ASC NULLS LAST, o_mod DESC, o_orderkey) = 1""",
)
def j5(t):
    newest = -F.unix_date("o_mod")
    return nearest_with_confidence(
        _admits(t), _opps(t), base_key="name_dob", base_day=F.col("day"), cand_key="o_name_dob", cand_day=F.col("o_day"),
        rank=[newest, F.col("o_orderkey")], carry=["o_orderkey"],
    )


def ratio_sql(a: str, b: str) -> str:
    """Indel ratio of two short texts in SQL (bit-parallel common subsequence)."""
    one = "CAST(1 AS BIGINT)"
    full = f"(({one} << CAST(length({a}) AS INTEGER)) - 1)"
    mask = (
        f"CAST(list_sum(list_transform(range(length({a})), lambda i: CASE WHEN {a}[i + 1] = c "
        f"THEN {one} << CAST(i AS INTEGER) ELSE 0 END)) AS BIGINT)"
    )
    return (
        f"200.0 * (length({a}) - bit_count(list_reduce(list_transform(string_split({b}, ''), lambda c: {mask}), "
        f"lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full}))) / (length({a}) + length({b}))"
    )


_BASE_SQL = """SELECT p_partkey AS base_id, CASE p_brand WHEN 'Brand#7' THEN 'Brand#77' WHEN 'Brand#8' THEN NULL ELSE p_brand END AS block,
  'P' || p_partkey AS id_key, p_name AS name, DATE '2000-01-01' + CAST(p_partkey % 400 AS INTEGER) AS day FROM part"""
_CAND_SQL = """SELECT p_partkey AS cand_id, p_brand AS cblock, CASE WHEN p_partkey % 5 = 0 THEN 'P' || (p_partkey + 1) END AS cid,
  CASE p_partkey % 4 WHEN 0 THEN p_name || 's' WHEN 1 THEN replace(p_name, 'a', 'ae') WHEN 2 THEN p_name || ' ' || p_size ELSE lower(p_type) || ' box' END AS cname,
  p_size <= 25 AS admitted, CASE WHEN p_partkey % 6 <> 0 THEN DATE '2000-01-01' + CAST(p_partkey * 7 % 400 AS INTEGER) END AS cday FROM part"""


def _parts(t):
    base = t.part.select(
        F.col("p_partkey").alias("base_id"),
        F.expr("CASE p_brand WHEN 'Brand#7' THEN 'Brand#77' WHEN 'Brand#8' THEN NULL ELSE p_brand END").alias("block"),
        F.expr("'P' || p_partkey").alias("id_key"), F.col("p_name").alias("name"),
        F.expr("date_add(DATE '2000-01-01', int(p_partkey % 400))").alias("day"),
    )
    cand = t.part.select(
        F.col("p_partkey").alias("cand_id"), F.col("p_brand").alias("cblock"),
        F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'P' || (p_partkey + 1) END").alias("cid"),
        F.expr(
            "CASE p_partkey % 4 WHEN 0 THEN p_name || 's' WHEN 1 THEN replace(p_name, 'a', 'ae') WHEN 2 THEN p_name || ' ' || p_size "
            "ELSE lower(p_type) || ' box' END"
        ).alias("cname"),
        (F.col("p_size") <= 25).alias("admitted"),
        F.expr("CASE WHEN p_partkey % 6 <> 0 THEN date_add(DATE '2000-01-01', int(p_partkey * 7 % 400)) END").alias("cday"),
    )
    return base, cand


@query(
    "j6_fuzzy_blocked",
    "base_id:i cand_id:i match_method:s match_confidence:i",
    sql=f"""
      WITH b AS ({_BASE_SQL}), c AS ({_CAND_SQL}),
      t1 AS (SELECT base_id, cand_id FROM b JOIN c ON block = cblock AND id_key = cid
             QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY admitted DESC, cday DESC NULLS LAST, cand_id) = 1),
      t2 AS (SELECT base_id, cand_id FROM b JOIN c ON block = cblock AND name = cname
             QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY admitted DESC, cday DESC NULLS LAST, cand_id) = 1),
      pairs AS (SELECT block, name, cname, {ratio_sql('name', 'cname')} AS score
                FROM (SELECT DISTINCT block, name FROM b) JOIN (SELECT DISTINCT cblock, cname FROM c) ON block = cblock),
      t3 AS (SELECT base_id, cand_id, score FROM b JOIN pairs USING (block, name) JOIN c ON c.cblock = b.block AND c.cname = pairs.cname
             WHERE score >= 88
             QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY score DESC, pairs.cname, admitted DESC, cday DESC NULLS LAST, cand_id) = 1)
      SELECT b.base_id, coalesce(t1.cand_id, t2.cand_id, t3.cand_id) AS cand_id,
             CASE WHEN block IS NULL THEN 'no match (unmapped block)' WHEN t1.cand_id IS NOT NULL THEN 'id + block' WHEN t2.cand_id IS NOT NULL THEN 'name + block'
                  WHEN t3.cand_id IS NOT NULL THEN 'name fuzzy' ELSE 'no match' END AS match_method,
             CASE WHEN t1.cand_id IS NOT NULL THEN 100 WHEN t2.cand_id IS NOT NULL THEN 95 WHEN t3.cand_id IS NOT NULL THEN floor(score) ELSE 0 END AS match_confidence
      FROM b LEFT JOIN t1 USING (base_id) LEFT JOIN t2 USING (base_id) LEFT JOIN t3 USING (base_id)""",
)
def j6(t):
    base, cand = _parts(t)
    prefer = [F.col("admitted").desc(), F.col("cday").desc_nulls_last(), F.col("cand_id").asc()]
    return block_match(
        base, cand, base_block="block", cand_block="cblock", base_id_key="id_key", cand_id_key="cid", base_name="name",
        cand_name="cname", prefer=prefer, carry=["cand_id"], threshold=88,
    )


_WORDS_SQL = "SELECT DISTINCT substr(w, 1, 1) AS block, w AS name FROM (SELECT unnest(regexp_extract_all(text, '[a-z]+')) AS w FROM {}) WHERE length(w) >= 6"


@query(
    "j6_similar_words",
    "block:s left_name:s right_name:s score:f",
    sql=f"""
      WITH a AS ({_WORDS_SQL.format("benchmark")}), b AS ({_WORDS_SQL.format("documents")}),
      near AS (SELECT block, a.name AS x, b.name AS y FROM a JOIN b USING (block) WHERE levenshtein(a.name, b.name) <= 0.12 * (length(a.name) + length(b.name)))
      SELECT block, x AS left_name, y AS right_name, score FROM (SELECT *, {ratio_sql('x', 'y')} AS score FROM near) WHERE score >= 88""",
)
def j6_words(t):
    """Words of one text collection that another spells alike; every word is a name, its first letter the block."""

    def words(texts):
        w = texts.select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0))).alias("name")).where(F.length("name") >= 6)
        return w.select(F.substring("name", 1, 1).alias("block"), "name")

    return similar_pairs(words(t.benchmark), words(t.documents), "block", "name", 88)


@query(
    "j7_fuzzy_reasoned",
    "base_id:i cand_id:i match_method:s",
    sql=f"""
      WITH b AS ({_BASE_SQL}), c AS ({_CAND_SQL}),
      t1 AS (SELECT base_id, cand_id FROM b JOIN c ON block = cblock AND id_key = cid
             QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY admitted DESC, cday DESC NULLS LAST, cand_id) = 1),
      pairs AS (SELECT block, name, cname, {ratio_sql('name', 'cname')} AS score
                FROM (SELECT DISTINCT block, name FROM b) JOIN (SELECT DISTINCT cblock, cname FROM c) ON block = cblock),
      t2 AS (SELECT base_id, cand_id, score FROM b JOIN pairs USING (block, name) JOIN c ON c.cblock = b.block AND c.cname = pairs.cname
             WHERE score >= 80 AND base_id NOT IN (SELECT base_id FROM t1)
             QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY score DESC, abs(cday - day) ASC NULLS LAST, pairs.cname, cand_id) = 1)
      SELECT b.base_id, coalesce(t1.cand_id, t2.cand_id) AS cand_id,
             CASE WHEN t1.cand_id IS NOT NULL THEN 'Tier 1: id + block'
                  WHEN t2.cand_id IS NOT NULL THEN 'Tier 2: name + block (sim=' || CAST(floor(score) AS INTEGER) || ')'
                  WHEN block IS NULL OR block NOT IN (SELECT cblock FROM c) THEN 'No match (block unknown)'
                  ELSE 'No match (name below threshold)' END AS match_method
      FROM b LEFT JOIN t1 USING (base_id) LEFT JOIN t2 USING (base_id)""",
)
def j7(t):
    base, cand = _parts(t)
    prefer = [F.col("admitted").desc(), F.col("cday").desc_nulls_last(), F.col("cand_id").asc()]
    return reasoned_match(
        base, cand, base_block="block", cand_block="cblock", base_id_key="id_key", cand_id_key="cid", base_name="name",
        cand_name="cname", base_day=F.col("day"), cand_day=F.col("cday"), prefer=prefer, rank=[F.col("cand_id")],
        carry=["cand_id"], threshold=80,
    )


_PROGRAM_MAP = [
    ("BUILDING", "F1", "L1", "Group A"), ("BUILDING", "", "", "Group B"), ("MACHINERY", "F2", "", "Group C"),
    ("FURNITURE", "", "", "Group D"), ("NULL", "", "", "Group N"),
]
_PROGRAM_SQL = "(VALUES " + ", ".join(str(r) for r in _PROGRAM_MAP) + ") AS m(program, facility, location, grp)"


@query(
    "j8_wildcard_map",
    "custkey:i program_group:s",
    sql=f"""
      WITH d AS (SELECT c_custkey AS custkey, coalesce(CASE WHEN c_nationkey <> 3 THEN c_mktsegment END, 'NULL') AS p, 'F' || (c_nationkey % 3) AS f,
                        CASE WHEN c_nationkey % 2 = 0 THEN 'L1' ELSE '' END AS l FROM customer)
      SELECT custkey, coalesce(e.grp, w.grp, 'UNMAPPED') AS program_group FROM d
      LEFT JOIN (SELECT * FROM {_PROGRAM_SQL} WHERE facility <> '' OR location <> '') e ON p = e.program AND f = e.facility AND l = e.location
      LEFT JOIN (SELECT * FROM {_PROGRAM_SQL} WHERE facility = '' AND location = '') w ON p = w.program""",
)
def j8(t):
    d = t.customer.select(
        F.col("c_custkey").alias("custkey"), F.expr("CASE WHEN c_nationkey <> 3 THEN c_mktsegment END").alias("program"),
        F.expr("'F' || (c_nationkey % 3)").alias("facility"), F.expr("CASE WHEN c_nationkey % 2 = 0 THEN 'L1' END").alias("location"),
    )
    m = literal_table(t.spark, _PROGRAM_MAP, "program string, facility string, location string, grp string")
    return M.map_with_wildcard(d, m, ["program", "facility", "location"], ["program", "facility", "location"], "grp", "program_group")


@query(
    "j9_single_key_map",
    "custkey:i payor_group:s",
    sql="""SELECT c_custkey AS custkey, CASE WHEN c_nationkey = 0 THEN 'Other' WHEN c_mktsegment = 'BUILDING' THEN 'X'
           WHEN c_mktsegment = 'FURNITURE' THEN 'Y' ELSE 'UNMAPPED' END AS payor_group FROM customer""",
)
def j9(t):
    d = t.customer.select(F.col("c_custkey").alias("custkey"), F.expr("CASE WHEN c_nationkey <> 0 THEN c_mktsegment ELSE ' ' END").alias("ins"))
    m = literal_table(t.spark, [("BUILDING", "X"), ("FURNITURE", "Y"), ("FURNITURE", "Z")], "ins_key string, grp string")
    return M.map_values(d, m, "ins", "ins_key", "grp", "payor_group", blank="Other")


@query(
    "j10_pair_map",
    "account_id:i source:s site:s n:i",
    sql="""SELECT account_id, source, CASE WHEN account_id = 0 AND source = 'Direct Line' THEN 'D0' WHEN account_id = 1 AND source = '' THEN 'B1' END AS site,
           count(*) AS n FROM (SELECT account_id, source FROM calls) GROUP BY ALL""",
    uses=["calls"],
)
def j10(t):
    m = literal_table(t.spark, [(0, "Direct Line ", "D0"), (1, None, "B1")], "acct int, src string, site string")
    out = M.map_pair(shapes.calls(t), m, ("account_id", "source"), ("acct", "src"), "site", "site")
    return out.groupBy("account_id", "source", "site").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j11_canonical_name",
    "name:s n:i",
    sql="""SELECT CASE WHEN p_size = 1 THEN NULL WHEN p_name = 'red ring' THEN 'Ring, red' WHEN p_name = 'old rod' THEN 'Rod, old' ELSE 'Unknown' END AS name,
           count(*) AS n FROM part GROUP BY 1""",
)
def j11(t):
    d = t.part.select(F.when(F.col("p_size") == 1, F.lit(" ")).otherwise(F.concat(F.lit(" "), F.regexp_replace(F.upper("p_name"), " ", "  "))).alias("name"))
    m = literal_table(t.spark, [("Red  Ring", "Ring, red"), ("old rod ", "Rod, old")], "raw string, canon string")
    return M.canonical_names(d, "name", m, "raw", "canon").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def _stage_frame(t, *kinds: str):
    return t.events.where(F.col("event_type").isin(*kinds)).select(
        week_ending(F.col("ts").cast("date")).alias("week"), F.expr("CASE WHEN user_id % 11 <> 0 THEN 'b' || (user_id % 11) END").alias("bucket"), "event_type", "value"
    )


@query(
    "j12_funnel_weekly",
    "week:s bucket:s leads:i opportunities:i vobs:i admits:i",
    sql="""SELECT CAST(ts AS DATE) + CAST((4 - dayofweek(ts) + 7) % 7 AS INTEGER) AS week, CASE WHEN user_id % 11 <> 0 THEN 'b' || (user_id % 11) END AS bucket,
           count(*) FILTER (WHERE event_type = 'view') AS leads, count(*) FILTER (WHERE event_type = 'click') AS opportunities,
           count(*) FILTER (WHERE event_type = 'signup' AND value > 20) AS vobs, count(*) FILTER (WHERE event_type = 'purchase') AS admits
           FROM events WHERE event_type <> 'error' GROUP BY 1, 2""",
)
def j12(t):
    e, kind = _stage_frame(t, "view", "click", "signup", "purchase"), F.col("event_type")
    return funnel(
        {"leads": (e, kind == "view"), "opportunities": (e, kind == "click"), "vobs": (e, (kind == "signup") & (F.col("value") > 20)), "admits": (e, kind == "purchase")},
        ["week", "bucket"],
    )


@query(
    "j12_full_outer_align",
    "week:s bucket:s leads:i admits:i",
    sql="""WITH e AS (SELECT CAST(ts AS DATE) + CAST((4 - dayofweek(ts) + 7) % 7 AS INTEGER) AS week,
                     CASE WHEN user_id % 11 <> 0 THEN 'b' || (user_id % 11) END AS bucket, event_type FROM events),
           l AS (SELECT week, bucket, count(*) AS leads FROM e WHERE event_type = 'view' GROUP BY 1, 2),
           a AS (SELECT week, bucket, count(*) AS admits FROM e WHERE event_type = 'purchase' GROUP BY 1, 2)
           SELECT week, bucket, coalesce(leads, 0) AS leads, coalesce(admits, 0) AS admits FROM l FULL OUTER JOIN a USING (week, bucket)""",
)
def j12b(t):
    leads = _stage_frame(t, "view").groupBy("week", "bucket").agg(F.count(F.lit(1)).alias("leads"))
    admits = _stage_frame(t, "purchase").groupBy("week", "bucket").agg(F.count(F.lit(1)).alias("admits"))
    return align_stages([leads, admits], ["week", "bucket"], ["leads", "admits"])


@query(
    "j13_missing_members",
    "value:s",
    sql="SELECT DISTINCT c_name AS value FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def j13(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.format_string("Customer#%09d", F.col("o_custkey")).alias("name"))
    return M.missing_members(t.customer, urgent, "c_name", "name")


@query(
    "j14_day_vs_baseline",
    "user_id:i calls:i base:i",
    sql="""WITH d AS (SELECT user_id, count(*) AS calls FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-29' GROUP BY 1),
           b AS (SELECT user_id, count(*) AS base FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-22', DATE '2024-01-15') GROUP BY 1)
           SELECT user_id, coalesce(calls, 0) AS calls, coalesce(base, 0) AS base FROM d FULL OUTER JOIN b USING (user_id)""",
)
def j14(t):
    e = t.events.select("user_id", F.col("ts").cast("date").alias("d"))
    day = e.where(F.col("d") == F.lit(date(2024, 1, 29))).groupBy("user_id").agg(F.count(F.lit(1)).alias("calls"))
    base = e.where(F.col("d").isin(date(2024, 1, 22), date(2024, 1, 15))).groupBy("user_id").agg(F.count(F.lit(1)).alias("base"))
    return align_on(day, base, "user_id", ["calls", "base"])


@query(
    "j15_exists_within",
    "id:i was_called:i",
    sql="""SELECT f.id, max(CASE WHEN o.id IS NOT NULL THEN 1 ELSE 0 END) AS was_called FROM classified f
           LEFT JOIN classified o ON o.caller_number = f.caller_number AND o.event_type = 'voice' AND o.direction = 'outbound'
                AND o.unix_time BETWEEN f.unix_time AND f.unix_time + 172800
           WHERE f.event_type = 'form_fill' GROUP BY 1""",
    uses=["classified"],
)
def j15(t):
    c = C.classify_calls(shapes.calls(t))
    forms = c.where(F.col("event_type") == "form_fill").select("id", "caller_number", "unix_time")
    out = c.where((F.col("event_type") == "voice") & (F.col("direction") == "outbound")).select(
        F.col("id").alias("out_id"), F.col("caller_number").alias("called"), F.col("unix_time").alias("out_time")
    )
    return C.exists_within(forms, out, key="caller_number", event_key="called", time="unix_time", event_time="out_time", event_id="out_id", seconds=2 * C.DAY)


@query(
    "j16_parent_attribute",
    "orderkey:i segment:s",
    sql="SELECT o_orderkey AS orderkey, CASE WHEN c_nationkey <> 2 THEN c_mktsegment END AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def j16(t):
    from funnelspark.functions.text import blank_to_null

    parent = t.customer.select("c_custkey", blank_to_null(F.expr("CASE WHEN c_nationkey <> 2 THEN c_mktsegment ELSE '--' END")).alias("segment"))
    return t.orders.join(parent, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_orderkey").alias("orderkey"), "segment")


@query(
    "j17_crosswalk_remap",
    "id:i agent_id:s",
    sql="""WITH n AS (SELECT id, agent_id, CASE WHEN user_id % 3 = 0 THEN 'smith' ELSE agent_name END AS name FROM calls),
           cnt AS (SELECT name, agent_id, count(*) AS r FROM n GROUP BY 1, 2),
           top AS (SELECT name, agent_id AS canonical FROM cnt QUALIFY row_number() OVER (PARTITION BY name ORDER BY r DESC, agent_id) = 1),
           own AS (SELECT agent_id, name FROM cnt QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY r DESC, name) = 1)
           SELECT id, coalesce(canonical, n.agent_id) AS agent_id FROM n LEFT JOIN own ON n.agent_id = own.agent_id LEFT JOIN top ON own.name = top.name""",
    uses=["calls"],
)
def j17(t):
    c = shapes.calls(t).withColumn("name", F.expr("CASE WHEN user_id % 3 = 0 THEN 'smith' ELSE agent_name END"))
    return M.remap_ids(c, canonical_members(c, "name", "agent_id"), "agent_id", "canonical_agent_id").select("id", "agent_id")


@query(
    "j18_month_spine",
    "week_ending:s entity:s type:s weekly_target:f",
    sql="""WITH w AS (SELECT CAST(d AS DATE) AS week_ending, last_day(CAST(d AS DATE)) AS month_ending,
                      count(*) OVER (PARTITION BY last_day(CAST(d AS DATE))) AS n FROM generate_series(DATE '1999-01-03', DATE '2000-03-26', INTERVAL 7 DAY) AS g(d))
           SELECT week_ending, entity, type, amount / n AS weekly_target FROM w JOIN budget USING (month_ending)""",
    uses=["budget"],
)
def j18(t):
    return weekly_targets(shapes.budget(t), "1999-01-03", "2000-03-26")


@query(
    "j19_group_total",
    "month_ending:s entity:s type:s share:f",
    sql="SELECT month_ending, entity, type, amount / sum(amount) OVER (PARTITION BY month_ending) AS share FROM budget",
    uses=["budget"],
)
def j19(t):
    total = F.sum("amount").over(Window.partitionBy("month_ending"))
    return shapes.budget(t).withColumn("share", F.col("amount") / total)
