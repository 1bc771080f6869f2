"""Queries of the projections, filters, scalar functions and classifiers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from funnelspark.functions import dates, fuzzy, rules, text
from funnelspark.operators.census import drop_test_rows
from funnelspark.operators.dedupe import union_all
from funnelspark.operators.calls import classify_calls
from funnelspark.operators.finance import text_flag
from funnelspark.operators.funnel import cohort_date, stage_flags
from funnelspark.plans import shapes
from funnelspark.plans.registry import query
from funnelspark.sources.tables import prefix_columns, project

# ---- projections and filters ---------------------------------------------------------------


@query(
    "p1_canonical_projection",
    "party_id:s source:s name:s nation:i balance:f segment:s",
    sql="""
      SELECT CAST(c_custkey AS VARCHAR) AS party_id, 'customer' AS source, c_name AS name, c_nationkey AS nation,
             c_acctbal AS balance, c_mktsegment AS segment FROM customer
      UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'supplier', s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def p1(t):
    one = {"party_id": "C_CUSTKEY", "source": F.lit("customer"), "name": "c_name", "nation": ("c_nationkey", "long"),
           "balance": ("c_acctbal", "double"), "segment": "c_mktsegment"}
    two = {"party_id": "s_suppkey", "source": F.lit("supplier"), "name": "s_name", "nation": ("s_nationkey", "long"),
           "balance": ("s_acctbal", "double"), "segment": "s_mktsegment"}
    return union_all(project(t.customer, one), project(t.supplier, two))


@query(
    "p2_date_window",
    "day:s orders:i",
    sql="""SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders
           WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-04-13' AND DATE '2000-06-29' GROUP BY 1""",
)
def p2(t):
    w = dates.recent_weeks(date(2000, 7, 2), 12, floor=date(1996, 1, 1))
    low, high = F.lit(w.start).cast("timestamp_ntz"), F.date_add(F.lit(w.end), 1).cast("timestamp_ntz")
    # a half-open range on the stored column, so that it is pushed to the scan
    d = t.orders.where((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high))
    return d.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "p3_test_rows",
    "brand:s kept:i",
    sql="""SELECT p_brand AS brand, count(*) AS kept FROM part
           WHERE p_partkey IN (1, 2, 3) OR (p_size > 5 AND NOT contains(lower(p_name), 'old') AND NOT contains(lower(p_type), 'old'))
           GROUP BY 1""",
)
def p3(t):
    p = t.part.withColumn("name", F.when(F.col("p_size") > 5, F.upper("p_name")))
    kept = drop_test_rows(p, "p_partkey", ["name", "p_type"], [1, 2, 3], word="old")
    return kept.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("kept"))


@query(
    "p4_scope_lists",
    "segment:s n:i",
    sql="""SELECT c_mktsegment AS segment, count(*) AS n FROM customer
           WHERE c_mktsegment IN ('BUILDING','MACHINERY','FURNITURE') AND c_nationkey NOT IN (3, 7) GROUP BY 1""",
)
def p4(t):
    c = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE") & ~F.col("c_nationkey").isin(3, 7))
    return c.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))


_CELL_SQL = "CASE l_returnflag WHEN 'R' THEN ' -- ' WHEN 'A' THEN '  ' ELSE l_linestatus END"


@query(
    "p5_presence",
    "flag:s present:i cleaned:i",
    sql=f"""SELECT l_returnflag AS flag, count(*) FILTER (WHERE trim({_CELL_SQL}) NOT IN ('', '--')) AS present,
            count(CASE WHEN trim({_CELL_SQL}) NOT IN ('', '--') THEN 1 END) AS cleaned FROM lineitem GROUP BY 1""",
)
def p5(t):
    cell = F.expr(_CELL_SQL)
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count_if(text.is_present(cell)).alias("present"), F.count(text.blank_to_null(cell)).alias("cleaned")
    )


@query(
    "p6_guarded_date",
    "orderkey:i born:s",
    sql="""SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 7 <> 0 AND CAST(o_orderdate AS DATE) <= DATE '2000-01-01'
           THEN CAST(o_orderdate AS DATE) END AS born FROM orders""",
)
def p6(t):
    raw = F.when(F.col("o_orderkey") % 7 == 0, F.lit("--")).otherwise(F.date_format("o_orderdate", "MM-dd-yyyy"))
    born = dates.guarded_date(raw, "MM-dd-yyyy", F.lit("2000-01-01").cast("date"))
    return t.orders.select(F.col("o_orderkey").alias("orderkey"), born.alias("born"))


@query(
    "p7_multi_format_timestamp",
    "orderkey:i day:s",
    sql="""SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""",
)
def p7(t):
    k = F.col("o_orderkey") % 4
    raw = (
        F.when(k == 0, F.date_format("o_orderdate", "MM-dd-yyyy h:mm a"))
        .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.lit("n/a"))
    )
    ts = dates.first_timestamp(raw, ["MM-dd-yyyy h:mm a", "yyyy-MM-dd HH:mm:ss", None])
    return t.orders.select(F.col("o_orderkey").alias("orderkey"), ts.cast("date").alias("day"))


@query(
    "p8_numeric_text",
    "flag:s numeric:i total:f",
    sql="""SELECT l_returnflag AS flag, count(*) FILTER (WHERE l_linestatus = 'F') AS numeric,
           sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS total FROM lineitem GROUP BY 1""",
)
def p8(t):
    raw = F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("string")).otherwise(
        F.concat(F.lit("$"), F.col("l_quantity").cast("string"))
    )
    n = text.numeric_text(raw)
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(n).alias("numeric"), F.sum(n).alias("total"))


@query(
    "p9_stage_flags",
    "program:s has_vob:i viable:i admits:i",
    sql="""SELECT program, count(*) FILTER (WHERE vob_status <> 'Self Pay') AS has_vob,
           count(*) FILTER (WHERE stage = 'Open') AS viable, count(*) FILTER (WHERE stage = 'Admitted') AS admits
           FROM opps GROUP BY 1""",
    uses=["opps"],
)
def p9(t):
    o = shapes.opportunities(t)
    vob = F.when(F.col("vob_status") == "Self Pay", F.lit(" pending")).otherwise(F.col("vob_status"))
    viable = F.when(F.col("stage") == "Open", F.lit("Viable VOBs"))
    f = stage_flags(F.trim(vob), viable, F.col("stage"))
    return o.groupBy("program").agg(
        F.count_if(f["has_vob"]).alias("has_vob"), F.count_if(f["is_viable"]).alias("viable"), F.count_if(f["is_admit"]).alias("admits")
    )


@query(
    "p10_cohort_anchor",
    "day:s n:i",
    sql="""SELECT CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) ELSE CAST(o_orderdate AS DATE) END AS day, count(*) AS n
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def p10(t):
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    matched = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("date"))
    return d.groupBy(cohort_date(matched, F.col("o_orderdate")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p11_audit_projection",
    "vob_id:s created_date:s pulled_by:s client_name:s payor:s program:s",
    sql="""SELECT CAST(o_orderkey AS VARCHAR) AS vob_id, CAST(o_orderdate AS DATE) AS created_date,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS pulled_by,
           c_mktsegment || ' ' || c_name AS client_name, CASE WHEN c_nationkey = 0 THEN c_mktsegment ELSE 'nation ' || c_nationkey END AS payor,
           c_mktsegment AS program FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def p11(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    who = F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(F.col("o_orderstatus"))
    payer = F.when(F.col("c_nationkey") == 0, F.lit(" ")).otherwise(F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")))
    return d.select(
        F.col("o_orderkey").cast("string").alias("vob_id"),
        F.col("o_orderdate").cast("date").alias("created_date"),
        text.blank_to_null(who, ("",)).alias("pulled_by"),
        F.trim(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("client_name"),
        F.coalesce(text.blank_to_null(payer, ("",)), text.blank_to_null(F.col("c_mktsegment"), ("",))).alias("payor"),
        text.blank_to_null(F.col("c_mktsegment"), ("",)).alias("program"),
    )


@query(
    "p12_prefix_join",
    "c_custkey:i nat_n_name:s nat_n_regionkey:i",
    sql="SELECT c_custkey, n_name AS nat_n_name, n_regionkey AS nat_n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def p12(t):
    return t.customer.join(prefix_columns(t.nation, "nat_"), F.col("c_nationkey") == F.col("nat_n_nationkey"), "left")


# ---- scalar functions ----------------------------------------------------------------------


@query(
    "k1_phone_e164",
    "custkey:i long_form:s short_form:s",
    sql="""SELECT c_custkey AS custkey,
           CASE WHEN length(d) = 11 AND d[1] = '1' THEN '+1' || d[2:] WHEN length(d) = 10 THEN '+1' || d ELSE '+' || d END AS long_form,
           CASE WHEN length(e) = 10 THEN '+1' || e WHEN length(e) >= 7 THEN '+' || e END AS short_form
           FROM (SELECT *, regexp_replace(c_nationkey || c_name, '[^0-9]', '', 'g') AS d,
                        regexp_replace(c_name[12 + CAST(c_custkey % 4 AS INTEGER):], '[^0-9]', '', 'g') AS e FROM customer)""",
)
def k1(t):
    return t.customer.select(
        F.col("c_custkey").alias("custkey"),
        text.phone_e164(F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_name")).alias("long_form"),
        text.phone_e164(F.expr("substring(c_name, int(12 + c_custkey % 4))")).alias("short_form"),
    )


@query(
    "k2_yes_no",
    "yes:i no:i unknown:i",
    sql="""SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS yes, count(*) FILTER (WHERE o_orderstatus = 'O') AS no,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS unknown FROM orders""",
)
def k2(t):
    v = text.yes_no(F.expr("CASE o_orderstatus WHEN 'F' THEN 'YES' WHEN 'O' THEN 'No' ELSE 'maybe' END"))
    return t.orders.agg(F.count_if(v).alias("yes"), F.count_if(~v).alias("no"), F.count_if(v.isNull()).alias("unknown"))


@query(
    "k3_name_keys",
    "custkey:i name_key:s name_birth_key:s letters:s mr:s",
    sql="""SELECT c_custkey AS custkey,
           CASE WHEN c_nationkey <> 0 THEN lower(c_mktsegment) || '|' || lower(c_name) END AS name_key,
           CASE WHEN c_nationkey <> 0 AND c_nationkey <> 5 THEN lower(c_mktsegment) || '|' || lower(c_name) || '|2000-01-01' END AS name_birth_key,
           lower(c_mktsegment) || ' customer' AS letters, CASE WHEN c_nationkey <> 0 THEN upper(c_name) END AS mr FROM customer""",
)
def k3(t):
    first = F.when(F.col("c_nationkey") != 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).otherwise(F.lit(" "))
    born = F.when(F.col("c_nationkey") != 5, F.lit("2000-01-01").cast("date"))
    return t.customer.select(
        F.col("c_custkey").alias("custkey"),
        text.name_key(first, F.col("c_name")).alias("name_key"),
        text.name_birth_key(first, F.col("c_name"), born).alias("name_birth_key"),
        text.letters_key(F.col("c_mktsegment"), F.col("c_name")).alias("letters"),
        text.id_key(F.when(F.col("c_nationkey") != 0, F.concat(F.lit(" "), F.lower("c_name")))).alias("mr"),
    )


@query(
    "k4_person_name",
    "name:s n:i",
    sql="""SELECT CASE WHEN p_name = 'red widget' THEN 'crimson widget' ELSE p_name END AS name, count(*) AS n FROM part GROUP BY 1""",
)
def k4(t):
    raw = F.concat(F.lit("  "), F.upper(F.regexp_replace("p_name", " ", "   ")), F.col("p_partkey").cast("string"), F.lit(". "))
    name = text.person_name(raw, {"red widget": "crimson widget"})
    return t.part.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("k5_strip_suffix", "partkey:i name:s", sql="SELECT p_partkey AS partkey, p_name AS name FROM part")
def k5(t):
    return t.part.select(
        F.col("p_partkey").alias("partkey"),
        text.strip_number_suffix(F.concat_ws("-", "p_name", F.col("p_partkey").cast("string"))).alias("name"),
    )


@query(
    "k6_split_name",
    "first:s last:s n:i",
    sql="SELECT string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[-1] AS last, count(*) AS n FROM part GROUP BY 1, 2",
)
def k6(t):
    return t.part.groupBy(text.first_token(F.col("p_name")).alias("first"), text.last_token(F.col("p_name")).alias("last")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "k7_plain_punctuation",
    "doc_id:i digest:s",
    sql="""SELECT doc_id, sha256(replace(replace(replace(trim('it’s – ' || text, ' '), chr(9), ''), '’', ''''), '–', '-')) AS digest
           FROM documents""",
)
def k7(t):
    d = t.documents
    return d.select("doc_id", F.sha2(text.plain_punctuation(F.concat(F.lit("it’s – "), F.col("text"))), 256).alias("digest"))


@query(
    "k8_display_text",
    "page_id:i slug:s initials:s label:s duration:s",
    sql="""SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS slug,
           CASE WHEN page_id % 3 = 0 THEN 'AL' ELSE 'AN' END AS initials,
           CASE WHEN page_id % 3 = 0 THEN 'Alpha' ELSE 'Alpha N.' END AS label,
           CASE WHEN length(html) >= 3600 THEN (length(html) // 3600) || 'h ' || lpad(CAST((length(html) % 3600) // 60 AS VARCHAR), 2, '0') || 'm'
                ELSE (length(html) // 60) || 'm' END AS duration FROM pages""",
)
def k8(t):
    name = F.when(F.col("page_id") % 3 == 0, F.lit(" Alpha ")).otherwise(F.lit("Alpha  von Nord"))
    return t.pages.select(
        "page_id",
        text.slug(F.col("url")).alias("slug"),
        text.initials(name).alias("initials"),
        text.short_label(name).alias("label"),
        text.duration_text(F.length("html")).alias("duration"),
    )


@query(
    "k9_row_hash",
    "custkey:i digest:s",
    sql="""SELECT c_custkey AS custkey, sha256(concat_ws('||', c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR))) AS digest FROM customer""",
)
def k9(t):
    return t.customer.select(
        F.col("c_custkey").alias("custkey"), text.row_hash(["c_nationkey", "c_name", "c_mktsegment"], compat=True).alias("digest")
    )


@query(
    "k10_token_test",
    "type:s red:i small:i",
    sql="""SELECT p_type AS type, count(*) FILTER (WHERE list_contains(string_split(p_name, ' '), 'red')) AS red,
           count(*) FILTER (WHERE list_contains(string_split(p_name, ' '), 'small') OR p_type = 'SMALL') AS small FROM part GROUP BY 1""",
)
def k10(t):
    s = F.concat_ws("|", "p_type", "p_name")
    return t.part.groupBy(F.col("p_type").alias("type")).agg(
        F.count_if(text.has_token(s, "red")).alias("red"), F.count_if(text.has_token(s, "small")).alias("small")
    )


@query(
    "k11_map_lookup",
    "nation:s area:s",
    sql="""SELECT n_name AS nation, CASE r_name WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'West' ELSE r_name END AS area
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def k11(t):
    d = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    area = rules.lookup(F.col("r_name"), {"ASIA": "East", "EUROPE": "West"}, F.col("r_name"))
    return d.select(F.col("n_name").alias("nation"), area.alias("area"))


@query(
    "k12_local_date",
    "day:s n:i",
    sql="SELECT CAST(ts - INTERVAL 6 HOUR AS DATE) AS day, count(*) AS n FROM events GROUP BY 1",
)
def k12(t):
    d = dates.local_date(shapes.epoch_seconds("ts"), "America/Chicago")
    return t.events.groupBy(d.alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k13_date_parts",
    "day:s year:i month_num:i month_name:s year_month:s quarter:s day_of_week:s dow_num:i week_ending:s is_weekend:i strict_sunday:s sunday:s monday:s n:i",
    sql="""SELECT d AS day, year(d) AS year, month(d) AS month_num, strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
           'Q' || quarter(d) AS quarter, strftime(d, '%A') AS day_of_week, dayofweek(d) + 1 AS dow_num,
           d + CAST((4 - dayofweek(d) + 7) % 7 AS INTEGER) AS week_ending, dayofweek(d) IN (0, 6) AS is_weekend,
           d + CAST(7 - dayofweek(d) AS INTEGER) AS strict_sunday, d + CAST((7 - dayofweek(d)) % 7 AS INTEGER) AS sunday,
           CAST(date_trunc('week', d) AS DATE) AS monday, count(*) AS n
           FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY ALL""",
)
def k13(t):
    d = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    day = F.col("day")
    return d.select(
        "day", "n", *[c.alias(n) for n, c in dates.date_parts(day).items()],
        dates.week_ending_strict(day).alias("strict_sunday"), dates.week_ending(day, "SUN").alias("sunday"),
        dates.week_start(day).alias("monday"),
    )


@query(
    "k14_call_outcome",
    "event_type:s direction:s outcome:s is_voice:i is_inbound_missed:i n:i",
    sql="SELECT event_type, direction, outcome, is_voice, is_inbound_missed, count(*) AS n FROM classified GROUP BY ALL",
    uses=["classified"],
)
def k14(t):
    return classify_calls(shapes.calls(t)).groupBy("event_type", "direction", "outcome", "is_voice", "is_inbound_missed").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "k15_callback_status",
    "callback_status:s callback_bucket:s n:i minutes:i",
    sql="""SELECT callback_status, callback_bucket, count(*) AS n, sum(callback_minutes) AS minutes FROM full_calls GROUP BY 1, 2""",
    uses=["full_calls"],
)
def k15(t):
    return shapes.full_calls(t).groupBy("callback_status", "callback_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("callback_minutes").alias("minutes")
    )


def _case_regex(col: str, pairs, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{v}'" for p, v in pairs) + f" ELSE {default} END"


_LAB = r"regexp_replace(lower(trim(coalesce(tracking_label, ''))), '\s+', ' ', 'g')"
_SRC = r"regexp_replace(lower(trim(coalesce(source, ''))), '\s+', ' ', 'g')"
_BY_LABEL = _case_regex(_LAB, rules.CHANNEL_BY_LABEL, f"CASE WHEN {_LAB} IN ('main line', 'north') THEN 'Direct' END")
_BY_SOURCE = _case_regex(_SRC, rules.CHANNEL_BY_SOURCE, "'Other'")
CHANNEL_SQL = f"coalesce(CASE WHEN {_LAB} <> '' AND NOT contains({_LAB}, 'unused') THEN {_BY_LABEL} END, {_BY_SOURCE})"
BRIEF_SQL = _case_regex(_SRC, rules.BRIEF_CHANNEL_BY_SOURCE, "'Other'")


@query(
    "k16_channel",
    "channel:s brief:s n:i",
    sql=f"SELECT {CHANNEL_SQL} AS channel, {BRIEF_SQL} AS brief, count(*) AS n FROM calls GROUP BY 1, 2",
    uses=["calls"],
)
def k16(t):
    c = rules.channel(F.col("tracking_label"), F.col("source"), ["Main Line", "North"])
    return shapes.calls(t).groupBy(c.alias("channel"), rules.brief_channel(F.col("source")).alias("brief")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "k16_dashboard_channel", "channel:s n:i",
    sql=f"""SELECT CASE WHEN s = '' THEN 'Unknown' WHEN s = 'outbound calls' THEN 'Outbound' WHEN contains(s, 'ai agent') OR contains(s, 'tawk to') THEN 'Chat'
              WHEN contains(s, 'billing number') OR contains(s, 'pre assessments') OR contains(s, 'other static') OR contains(s, 'seo') OR s = 'mat' THEN 'Other'
              WHEN s LIKE 'ppc %' OR s LIKE 'ppc-%' OR s LIKE 'meta %' OR regexp_matches(s, 'google ads|facebook paid|facebook cta|fb ads|geofencing|linkedin|pmax|performance max') THEN 'PPC'
              WHEN s = 'print' THEN 'Other' WHEN regexp_matches(s, 'organic|gmb|bing local') THEN 'Organic' WHEN regexp_matches(s, 'referral|facility transfer') THEN 'Referral'
              WHEN regexp_matches(s, 'direct|target number|website') THEN 'Direct' WHEN s = 'north' THEN 'Direct' ELSE 'Other' END AS channel, count(*) AS n
            FROM (SELECT {_SRC} AS s FROM calls) GROUP BY 1""",
    uses=["calls"],
)
def k16_dashboard(t):
    c = rules.dashboard_channel(F.col("source"), ["North"], ["SEO"])
    return shapes.calls(t).groupBy(c.alias("channel")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k17_admit_lead_type", "lead_type:s n:i",
    sql="""SELECT CASE WHEN user_id % 7 = 0 OR user_id % 11 = 0 THEN 'BD' WHEN regexp_matches(s, 'alumni|word of mouth|readmission') THEN 'Alumni'
             WHEN regexp_matches(s, 'google ads|ppc|pmax|paid') THEN 'PPC' WHEN regexp_matches(s, 'internet search|organic|gmb|website|direct site') THEN 'SEO' ELSE 'Other' END AS lead_type,
           count(*) AS n FROM (SELECT user_id, lower(coalesce(source, '') || ' ' || coalesce(tracking_label, '')) AS s FROM calls) GROUP BY 1""",
    uses=["calls"],
)
def k17_admit(t):
    company, contact = F.when(F.col("user_id") % 7 == 0, F.lit("partner")), F.when(F.col("user_id") % 11 == 0, F.lit("somebody")).otherwise(F.lit(" "))
    c = rules.admit_lead_type(company, contact, F.col("source"), F.col("tracking_label"))
    return shapes.calls(t).groupBy(c.alias("lead_type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k17_lead_type",
    "lead_type:s stored:s n:i",
    sql=f"""SELECT CASE WHEN user_id % 7 = 0 THEN 'BD' ELSE {_case_regex("lower(coalesce(source, '') || ' ' || coalesce(tracking_label, ''))",
            rules.LEAD_TYPE_PATTERNS, "'Other'")} END AS lead_type,
            CASE user_id % 5 WHEN 0 THEN 'BD' WHEN 1 THEN 'Step Down' WHEN 2 THEN 'PPC' ELSE 'Other' END AS stored, count(*) AS n
            FROM calls GROUP BY 1, 2""",
    uses=["calls"],
)
def k17(t):
    c = shapes.calls(t)
    sig = rules.referred(F.when(F.col("user_id") % 7 == 0, F.lit("partner")).otherwise(F.lit("--")))
    raw = F.expr("CASE user_id % 5 WHEN 0 THEN ' bd' WHEN 1 THEN 'Step-Down' WHEN 2 THEN 'Ppc' WHEN 3 THEN '' END")
    return c.groupBy(
        rules.lead_type(sig, F.col("source"), F.col("tracking_label")).alias("lead_type"), rules.lead_type_name(raw).alias("stored")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k18_label_site",
    "label:s site:s n:i",
    sql="""SELECT tracking_label AS label, CASE WHEN regexp_matches(coalesce(tracking_label, ''), '(?i)\\b(?:north)\\b') THEN 'N-site'
           WHEN regexp_matches(coalesce(tracking_label, ''), '(?i)\\b(?:gmb|alph)\\b') THEN 'A-site' ELSE 'none' END AS site, count(*) AS n
           FROM calls GROUP BY 1, 2""",
    uses=["calls"],
)
def k18(t):
    site = rules.label_site(F.col("tracking_label"), [(["NORTH"], "N-site"), (["gmb", "alph"], "A-site")], "none")
    return shapes.calls(t).groupBy(F.col("tracking_label").alias("label"), site.alias("site")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k19_campaign_map",
    "site:s channel:s n:i",
    sql="""SELECT CASE WHEN account_name = 'Main Account' THEN 'Main' WHEN campaign_name LIKE 'Pmax%' THEN 'Alpha'
           WHEN campaign_name LIKE 'S|%' THEN 'Beta' ELSE 'Unmapped' END AS site,
           CASE WHEN campaign_name LIKE 'Pmax%' THEN 'Performance Max' WHEN campaign_name LIKE 'S|%' THEN 'Search' ELSE 'Brand Search' END AS channel,
           count(*) AS n FROM spend GROUP BY 1, 2""",
    uses=["spend"],
)
def k19(t):
    site = rules.campaign_site(
        F.col("campaign_name"), F.col("account_name"), {"Main Account": "Main"}, [(["alpha", "a"], "Alpha"), (["beta"], "Beta")]
    )
    return shapes.spend(t).groupBy(site.alias("site"), rules.campaign_channel(F.col("campaign_name")).alias("channel")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "k20_site_crosswalk",
    "host:s n:i",
    sql="""SELECT CASE WHEN contains(lower(url), 'm.') THEN 'mobile' WHEN contains(lower(url), 'blog') THEN 'blog'
           WHEN contains(lower(url), '.org') THEN 'org' ELSE 'plain' END AS host, count(*) AS n FROM pages GROUP BY 1""",
)
def k20(t):
    host = rules.contains_first(F.col("url"), [("m.", "mobile"), ("blog", "blog"), (".org", "org")], "plain")
    return t.pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k21_channel_group",
    "channel_group:s n:i",
    sql=f"""SELECT {_case_regex("lower(coalesce(source, '') || ' ' || coalesce(tracking_label, ''))", rules.CHANNEL_GROUPS, "'Other'")}
            AS channel_group, count(*) AS n FROM calls GROUP BY 1""",
    uses=["calls"],
)
def k21(t):
    return shapes.calls(t).groupBy(rules.channel_group(F.col("source"), F.col("tracking_label")).alias("channel_group")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "k22_disposition",
    "bucket:s n:i",
    sql="""SELECT CASE k % 6 WHEN 0 THEN 'Qualified' WHEN 1 THEN 'Junk' WHEN 2 THEN 'Disqualified' WHEN 3 THEN 'Spanish only'
           ELSE 'Unknown / no disposition' END AS bucket, count(*) AS n FROM calls GROUP BY 1""",
    uses=["calls"],
)
def k22(t):
    raw = F.expr("CASE k % 6 WHEN 0 THEN 'Good Call' WHEN 1 THEN 'Spam' WHEN 2 THEN 'Uninsured' WHEN 3 THEN 'Spanish only' WHEN 4 THEN 'x' END")
    return shapes.calls(t).groupBy(rules.disposition(raw).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k23_budget_category",
    "category:s n:i",
    sql="""SELECT CASE WHEN facility = 'F0' AND payor = 'P0' THEN 'First' WHEN facility = 'F0' AND payor <> 'P0' THEN 'First other'
           WHEN contains(program, 'click') OR contains(program, 'sign') THEN 'Second' ELSE 'Unbudgeted' END AS category, count(*) AS n
           FROM census_rows GROUP BY 1""",
    uses=["census_rows"],
)
def k23(t):
    cat = rules.budget_category(
        [({"facility": "F0", "payor": "P0"}, "First"), ({"facility": "F0", "payor": "!P0"}, "First other"), ({"program": ("click", "sign")}, "Second")]
    )
    return shapes.census_rows(t).groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k24_era",
    "era:s n:i",
    sql="""SELECT CASE WHEN o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) <= DATE '1998-04-30' THEN 'early' ELSE 'late' END AS era,
           count(*) AS n FROM orders GROUP BY 1""",
)
def k24(t):
    d = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return t.orders.groupBy(rules.era(d, "1998-04-30", "early", "late").alias("era")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k25_value_bands",
    "program:s sort_order:i flag:s n:i",
    sql="""SELECT CASE WHEN program IN ('view', 'click') THEN 'browse' ELSE program END AS program,
           CASE program WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 ELSE 7 END AS sort_order,
           CASE WHEN contains(lower(coalesce(discharge_type, '')), 'am') THEN 'hit' ELSE 'miss' END AS flag, count(*) AS n
           FROM census_rows GROUP BY 1, 2, 3""",
    uses=["census_rows"],
)
def k25(t):
    p = F.col("program")
    return shapes.census_rows(t).groupBy(
        rules.lookup(p, {"view": "browse", "click": "browse"}, p).alias("program"),
        rules.lookup(p, {"view": 1, "click": 1, "signup": 2}, 7).alias("sort_order"),
        text_flag(F.col("discharge_type"), "AM", "hit", "miss").alias("flag"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k26_fiscal_calendar",
    "month_ending:s start:i fiscal_year:i fiscal_period:i n:i",
    sql="""SELECT last_day(d) AS month_ending, s AS start, year(last_day(d) - to_months(CAST(s - 1 AS INTEGER))) AS fiscal_year,
           month(last_day(d) - to_months(CAST(s - 1 AS INTEGER))) AS fiscal_period, count(*) AS n
           FROM (SELECT CAST(o_orderdate AS DATE) AS d, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 10 END AS s FROM orders)
           GROUP BY ALL""",
)
def k26(t):
    o = t.orders.select(
        dates.month_end(F.col("o_orderdate").cast("date")).alias("month_ending"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 10 END").alias("start"),
    )
    return o.groupBy("month_ending", "start").agg(F.count(F.lit(1)).alias("n")).select(
        "*",
        dates.fiscal_year(F.col("month_ending"), F.col("start")).alias("fiscal_year"),
        dates.fiscal_period(F.col("month_ending"), F.col("start")).alias("fiscal_period"),
    )


_LCS_SQL = """
  SELECT partkey, 200.0 * (length(a) - bit_count(list_reduce(
             list_transform(string_split(b, ''), lambda c: CAST(list_sum(list_transform(range(length(a)),
                 lambda i: CASE WHEN a[i + 1] = c THEN CAST(1 AS BIGINT) << CAST(i AS INTEGER) ELSE 0 END)) AS BIGINT)),
             lambda r, m: ((r + (r & m)) | (r - (r & m))) & ((CAST(1 AS BIGINT) << CAST(length(a) AS INTEGER)) - 1),
             (CAST(1 AS BIGINT) << CAST(length(a) AS INTEGER)) - 1))) / (length(a) + length(b)) AS ratio
  FROM (SELECT p_partkey AS partkey, p_name AS a, lower(p_type) || ' ' || string_split(p_name, ' ')[2] AS b FROM part)"""


@query("f1_name_ratio_indel", "partkey:i ratio:f", sql=_LCS_SQL)
def f1_indel(t):
    b = F.concat_ws(" ", F.lower("p_type"), text.last_token(F.col("p_name")))
    return t.part.select(F.col("p_partkey").alias("partkey"), fuzzy.name_ratio(F.col("p_name"), b).alias("ratio"))


@query(
    "f1_name_ratio_levenshtein",
    "partkey:i ratio:f",
    sql="""SELECT partkey, 100.0 * (1 - levenshtein(a, b) / greatest(length(a), length(b))) AS ratio
           FROM (SELECT p_partkey AS partkey, p_name AS a, lower(p_type) || ' ' || string_split(p_name, ' ')[2] AS b FROM part)""",
)
def f1_lev(t):
    b = F.concat_ws(" ", F.lower("p_type"), text.last_token(F.col("p_name")))
    return t.part.select(F.col("p_partkey").alias("partkey"), fuzzy.name_ratio(F.col("p_name"), b, "levenshtein").alias("ratio"))


@query(
    "g1_nested_fields",
    "event_type:s k_sum:i k_max:i n:i",
    sql="""SELECT event_type, sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS k_sum, max(CAST(json_extract(props, '$.k') AS INTEGER)) AS k_max,
           count(*) AS n FROM events GROUP BY 1""",
)
def g1(t):
    e = t.events.withColumn("p", F.from_json("props", "k int"))
    return e.groupBy("event_type").agg(F.sum("p.k").alias("k_sum"), F.max("p.k").alias("k_max"), F.count(F.lit(1)).alias("n"))
