"""Queries of the aggregates, windows, top-k and set operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from funnelspark.functions import dates, rules
from funnelspark.operators import calls as C
from funnelspark.operators import census as S
from funnelspark.operators import dedupe as D
from funnelspark.operators import identity
from funnelspark.operators import history as H
from funnelspark.operators import mapping as M
from funnelspark.operators import quality as Q
from funnelspark.operators import scoring as P
from funnelspark.operators import topk as K
from funnelspark.operators.funnel import entity_volume, funnel, stage_counts
from funnelspark.operators.spend import rollup_spend
from funnelspark.plans import shapes
from funnelspark.plans.catalog_functions import BRIEF_SQL, CHANNEL_SQL
from funnelspark.plans.registry import query
from funnelspark.session import materialise
from funnelspark.sources.tables import literal_table

DAY = date(2024, 1, 29)
_D = "DATE '2024-01-29'"
_BASE = "(DATE '2024-01-22', DATE '2024-01-15', DATE '2024-01-08', DATE '2024-01-01')"


def _channelled(t):
    return shapes.full_calls(t).withColumn("channel", rules.channel(F.col("tracking_label"), F.col("source")))


def _pct(a: str, b: str, n: int = 2) -> str:
    return f"CASE WHEN {b} > 0 THEN round(100.0 * {a} / {b}, {n}) END"


# ---- aggregates ----------------------------------------------------------------------------


@query(
    "a1_daily_stats",
    "call_date:s facility:s account_id:i total_events:i voice_total:i voice_answered:i voice_missed:i voice_voicemail:i "
    "voice_quick_hangup:i voice_abandoned:i inbound_total:i outbound_total:i sms_total:i form_total:i talk_time_seconds:i "
    "callbacks_needed:i callbacks_made_any:i callbacks_made_same_agent:i answer_rate_pct:f miss_rate_pct:f "
    "callback_rate_any_pct:f callback_rate_same_pct:f week_ending:s",
    sql=f"""
      WITH g AS (SELECT call_date, facility, account_id, count(*) AS total_events, count(*) FILTER (WHERE is_voice) AS voice_total,
        count(*) FILTER (WHERE outcome = 'answered') AS voice_answered, count(*) FILTER (WHERE outcome = 'missed') AS voice_missed,
        count(*) FILTER (WHERE outcome = 'voicemail') AS voice_voicemail, count(*) FILTER (WHERE outcome = 'quick_hangup') AS voice_quick_hangup,
        count(*) FILTER (WHERE outcome = 'abandoned_on_hold') AS voice_abandoned, count(*) FILTER (WHERE direction = 'inbound') AS inbound_total,
        count(*) FILTER (WHERE direction = 'outbound') AS outbound_total, count(*) FILTER (WHERE event_type = 'sms') AS sms_total,
        count(*) FILTER (WHERE event_type = 'form_fill') AS form_total, sum(coalesce(talk_time, 0)) AS talk_time_seconds,
        count(*) FILTER (WHERE needs_callback) AS callbacks_needed, count(*) FILTER (WHERE callback_status = 'called_back') AS callbacks_made_any,
        count(*) FILTER (WHERE callback_by_same_agent) AS callbacks_made_same_agent FROM full_calls GROUP BY 1, 2, 3)
      SELECT *, {_pct('voice_answered', 'voice_total')} AS answer_rate_pct,
        {_pct('(voice_missed + voice_voicemail + voice_abandoned)', 'inbound_total')} AS miss_rate_pct,
        {_pct('callbacks_made_any', 'callbacks_needed')} AS callback_rate_any_pct,
        {_pct('callbacks_made_same_agent', 'callbacks_needed')} AS callback_rate_same_pct,
        call_date + CAST((4 - dayofweek(call_date) + 7) % 7 AS INTEGER) AS week_ending FROM g""",
    uses=["full_calls"],
)
def a1(t):
    return C.daily_stats(shapes.full_calls(t), ["call_date", "facility", "account_id"]).withColumn(
        "week_ending", dates.week_ending(F.col("call_date"))
    )


@query(
    "a2_agent_stats",
    "call_date:s agent_id:s calls_answered:i calls_missed_assigned:i callbacks_made:i talk_time_seconds:i total_voice_calls:i "
    "avg_talk_time_seconds:f answer_rate_pct:f",
    sql=f"""
      WITH a AS (SELECT call_date, agent_id, count(*) FILTER (WHERE outcome = 'answered') AS calls_answered,
                   count(*) FILTER (WHERE is_inbound_missed) AS calls_missed_assigned, sum(coalesce(talk_time, 0)) AS talk_time_seconds,
                   count(*) AS total_voice_calls FROM full_calls WHERE agent_id IS NOT NULL AND is_voice GROUP BY 1, 2),
      b AS (SELECT call_date, callback_by_agent_id AS agent_id, count(*) AS made FROM full_calls WHERE callback_by_agent_id IS NOT NULL GROUP BY 1, 2)
      SELECT a.*, coalesce(made, 0) AS callbacks_made,
        CASE WHEN calls_answered > 0 THEN round(talk_time_seconds / calls_answered, 1) END AS avg_talk_time_seconds,
        {_pct('calls_answered', 'total_voice_calls')} AS answer_rate_pct FROM a LEFT JOIN b USING (call_date, agent_id)""",
    uses=["full_calls"],
)
def a2(t):
    return C.agent_stats(shapes.full_calls(t))


_SPEND_SQL = """
  WITH g AS (SELECT {period} AS period, campaign_id, account_id, sum(cost) AS cost, sum(impressions) AS impressions, sum(clicks) AS clicks,
             sum(conversions) AS conversions, sum(conversions_value) AS conversions_value FROM spend GROUP BY 1, 2, 3)
  SELECT *, CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0 END AS ctr, CASE WHEN clicks > 0 THEN cost / clicks ELSE 0 END AS avg_cpc,
         CASE WHEN cost > 0 THEN conversions_value / cost ELSE 0 END AS roas FROM g"""
_SPEND_COLS = "period:s campaign_id:i account_id:i cost:f impressions:f clicks:f conversions:f conversions_value:f ctr:f avg_cpc:f roas:f"


@query(
    "a3_spend_weekly", _SPEND_COLS, sql=_SPEND_SQL.format(period="date + CAST((4 - dayofweek(date) + 7) % 7 AS INTEGER)"), uses=["spend"]
)
def a3w(t):
    return rollup_spend(shapes.spend(t), dates.week_ending(F.col("date")), "period", ["campaign_id", "account_id"])


@query("a3_spend_monthly", _SPEND_COLS, sql=_SPEND_SQL.format(period="CAST(date_trunc('month', date) AS DATE)"), uses=["spend"])
def a3m(t):
    return rollup_spend(shapes.spend(t), dates.month_start(F.col("date")), "period", ["campaign_id", "account_id"])


@query(
    "a4_stage_counts",
    "month:s program:s lead_type:s opener:s opps:i vobs:i admits:i",
    sql="""SELECT date_trunc('month', created_day)::DATE AS month, program, lead_type, opener, count(*) AS opps,
           count(*) FILTER (WHERE vob_status <> 'Self Pay') AS vobs, count(*) FILTER (WHERE stage = 'Admitted') AS admits FROM opps GROUP BY ALL""",
    uses=["opps"],
)
def a4(t):
    o = shapes.opportunities(t).withColumn("month", dates.month_start(F.col("created_day")))
    return funnel(
        {"opps": (o, F.lit(True)), "vobs": (o, F.col("vob_status") != "Self Pay"), "admits": (o, F.col("stage") == "Admitted")},
        ["month", "program", "lead_type", "opener"],
    )


@query(
    "a5_entity_volume",
    "period:s entities:i",
    sql="""SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period, count(*) AS entities
           FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1) GROUP BY 1""",
)
def a5(t):
    return entity_volume(
        t.orders, "o_custkey", "o_orderdate", "o_orderdate", dates.week_ending(F.col("o_orderdate").cast("date"), "SUN"), ["o_orderkey"]
    )


@query(
    "a6_unmapped_audit",
    "account_id:i source:s row_count:i first_seen:s last_seen:s sample:s is_new:i",
    sql="""SELECT CASE WHEN account_id = 2 THEN NULL ELSE account_id END AS account_id, source, count(*) AS row_count, min(call_date) AS first_seen,
           max(call_date) AS last_seen, min(tracking_label) AS sample,
           NOT (account_id = 1 AND source = 'AI Agent' OR account_id = 2 AND source = 'Google Ads Search') AS is_new
           FROM calls WHERE source <> 'Direct Line' GROUP BY account_id, source""",
    uses=["calls"],
)
def a6(t):
    c = shapes.calls(t).withColumn("account_id", F.when(F.col("account_id") != 2, F.col("account_id")))
    seen = literal_table(t.spark, [(1, "AI Agent"), (None, "Google Ads Search")], "account_id long, source string")
    return M.unmapped_audit(c, F.col("source") != "Direct Line", ["account_id", "source"], "call_date", "tracking_label", seen)


@query(
    "a6_cast_quarantine",
    "raw:s n:i",
    sql="SELECT o_orderpriority AS raw, count(*) AS n FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1",
)
def a6b(t):
    o = t.orders.withColumn("raw", F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("3")).otherwise(F.col("o_orderpriority")))
    return M.cast_failures(o, "raw", "int").groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a7_canonical_member",
    "p_name:s ids:i rows:i",
    sql="""SELECT p_name, count(DISTINCT p_brand) AS ids, count(*) AS rows FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""",
)
def a7(t):
    return D.merged_members(t.part, "p_name", "p_brand")


@query(
    "a7_identity_closure", "id:i canonical:i group_size:i",
    sql="""WITH RECURSIVE e AS (
             SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer WHERE c_nationkey % 4 <> 0 UNION ALL SELECT c_custkey + 2, c_custkey FROM customer WHERE c_nationkey % 5 = 1
           ), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS x, a AS y FROM u UNION SELECT r.x, u.b FROM r JOIN u ON u.a = r.y),
           g AS (SELECT x, min(y) AS least, count(*) AS group_size FROM r GROUP BY x),
           best AS (SELECT least, first(x ORDER BY coalesce(c_acctbal, 1e18), x) AS canonical FROM g LEFT JOIN customer ON c_custkey = x GROUP BY least)
           SELECT x AS id, canonical, group_size FROM g JOIN best USING (least)""",
)
def a7_closure(t):
    """Alias pairs of customers, chained and closed to cycles; the member with the least balance names the group."""
    c = t.customer
    pairs = c.where("c_nationkey % 4 <> 0").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 1).alias("b"))
    pairs = pairs.union(c.where("c_nationkey % 5 = 1").select(F.col("c_custkey") + 2, F.col("c_custkey")))
    return identity.canonical_ids(pairs, "a", "b", c.select(F.col("c_custkey").alias("id"), "c_acctbal"), F.col("c_acctbal"))


@query(
    "a8_coverage",
    "facility:s patient_days:i unique_ids:i from_date:s to_date:s",
    sql="""SELECT facility, count(*) AS patient_days, count(DISTINCT casefile_id) AS unique_ids, min(census_date) AS from_date,
           max(census_date) AS to_date FROM census GROUP BY 1""",
    uses=["census"],
)
def a8(t):
    return S.coverage(shapes.census(t), ["facility"], "casefile_id", "census_date")


@query(
    "a9_approx_quantile", "flag:s n:i is_value:i within:i",
    sql="SELECT l_returnflag AS flag, count(*) AS n, true AS is_value, true AS within FROM lineitem GROUP BY 1",
)
def a9(t):
    """The approximate median is a value of the group, and its rank is within the stated error of n / accuracy."""
    rows = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("price"))
    one = rows.groupBy("flag").agg(F.percentile_approx("price", 0.5, 20).alias("approx"))
    ranks = rows.join(one, "flag").groupBy("flag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price") < F.col("approx")).alias("below"), F.count_if(F.col("price") == F.col("approx")).alias("equal")
    )
    middle = F.col("n") / 2
    within = (F.col("below") <= middle + F.col("n") / 20) & (F.col("below") + F.col("equal") >= middle - F.col("n") / 20)
    return ranks.select("flag", "n", (F.col("equal") > 0).alias("is_value"), within.alias("within"))


@query(
    "a10_median_mean",
    "agent_id:s median_min:f mean_min:f",
    sql="""SELECT agent_id, median(callback_minutes) AS median_min, avg(callback_minutes) AS mean_min FROM full_calls
           WHERE callback_status = 'called_back' GROUP BY 1""",
    uses=["full_calls"],
)
def a10(t):
    c = shapes.full_calls(t).where(F.col("callback_status") == "called_back")
    # whole minutes inside a seven-day window: at most 10,081 distinct values per group
    return c.groupBy("agent_id").agg(F.median("callback_minutes").alias("median_min"), F.avg("callback_minutes").alias("mean_min"))


@query(
    "a11_weekday_baseline",
    "dim:s value:s calls:i base_daily:f",
    sql=f"""
      WITH c AS (SELECT 'state' AS dim, state AS value, call_date FROM calls UNION ALL SELECT 'source', source, call_date FROM calls
                 UNION ALL SELECT 'rep', agent_id, call_date FROM calls)
      SELECT dim, value, count(*) FILTER (WHERE call_date = {_D}) AS calls, round(count(*) FILTER (WHERE call_date <> {_D}) / 4, 1) AS base_daily
      FROM c WHERE call_date = {_D} OR call_date IN {_BASE} GROUP BY 1, 2""",
    uses=["calls"],
)
def a11(t):
    c = shapes.calls(t)
    parts = [
        C.weekday_baseline(c, col, DAY).select(F.lit(dim).alias("dim"), F.col(col).alias("value"), "calls", "base_daily")
        for dim, col in (("state", "state"), ("source", "source"), ("rep", "agent_id"))
    ]
    return D.union_all(*parts)


_SUSTAINED_SQL = f"""
  WITH b AS (SELECT user_id, count(*) / 3 AS wk FROM calls WHERE call_date IN (DATE '2024-01-22', DATE '2024-01-15', DATE '2024-01-08') GROUP BY 1),
  r AS (SELECT user_id, call_date, count(*) AS c FROM calls WHERE call_date BETWEEN DATE '2024-01-28' AND {_D} GROUP BY 1, 2)
  SELECT user_id, count(*) FILTER (WHERE c <= wk * 0.6) AS days_below, count(*) AS days_seen, round(min(wk), 1) AS wk_avg
  FROM r JOIN b USING (user_id) WHERE wk >= 2 GROUP BY 1 HAVING count(*) FILTER (WHERE c <= wk * 0.6) >= 2"""


@query("a12_sustained_drop", "user_id:i days_below:i days_seen:i wk_avg:f", sql=_SUSTAINED_SQL, uses=["calls"])
def a12(t):
    return C.sustained_drop(shapes.calls(t), "user_id", DAY, days=2)


@query(
    "a13_threshold_flags",
    "flag:s kind:s subject:s",
    sql=f"""
      WITH s AS (SELECT state, count(*) FILTER (WHERE call_date = {_D}) AS n, round(count(*) FILTER (WHERE call_date <> {_D}) / 4, 1) AS b
                 FROM full_calls WHERE call_date = {_D} OR call_date IN {_BASE} GROUP BY 1),
      d AS (SELECT * FROM full_calls WHERE call_date = {_D}),
      r AS (SELECT agent_id, count(*) FILTER (WHERE callback_status = 'called_back') AS made, count(*) FILTER (WHERE needs_callback) AS need
            FROM d WHERE is_voice AND agent_id IS NOT NULL GROUP BY 1),
      x AS (SELECT {_pct("count(*) FILTER (WHERE is_voice AND direction = 'inbound' AND is_inbound_missed)", "count(*) FILTER (WHERE is_voice AND direction = 'inbound')", 1)} AS miss,
                   median(callback_minutes) FILTER (WHERE callback_status = 'called_back') AS med,
                   {_pct("count(*) FILTER (WHERE callback_status = 'called_back')", "count(*) FILTER (WHERE needs_callback)", 1)} AS rate FROM d)
      SELECT 'volume_drop' AS flag, 'state' AS kind, state AS subject FROM s WHERE b >= 10 AND n <= b * 0.9
      UNION ALL SELECT 'sustained_drop', 'user', CAST(user_id AS VARCHAR) FROM ({_SUSTAINED_SQL})
      UNION ALL SELECT 'no_callbacks', 'rep', agent_id FROM r WHERE need >= 2 AND made = 0
      UNION ALL SELECT 'miss_rate', 'day', 'all' FROM x WHERE miss >= 15 UNION ALL SELECT 'slow_callbacks', 'day', 'all' FROM x WHERE med > 60
      UNION ALL SELECT 'callback_rate', 'day', 'all' FROM x WHERE rate < 50""",
    uses=["full_calls", "calls"],
)
def a13(t):
    # four reports read these rows: written once to the shared folder instead of computed four times
    c = materialise(_channelled(t), "a13")
    drops = C.volume_drop_flags(C.weekday_baseline(c, "state", DAY), "state", "state", min_base=10, ratio=0.9)
    slow = C.sustained_flags(C.sustained_drop(c, "user_id", DAY, days=2), "user_id", "user")
    idle = C.idle_rep_flags(C.rep_scorecard(c, DAY))
    level = C.level_flags(C.hero_kpis(c, DAY).withColumn("callback_rate_pct", C.pct(F.col("callbacks_made"), F.col("callbacks_needed"), 1)))
    return D.union_all(drops, slow, idle, level)


@query(
    "a13_form_flags", "flag:s kind:s subject:s",
    sql="""WITH f AS (SELECT DISTINCT caller_number, unix_time, source, state, tracking_label, call_date FROM classified WHERE event_type = 'form_fill'),
           s AS (SELECT f.call_date, count(*) AS forms, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM classified o WHERE o.caller_number = f.caller_number AND o.event_type = 'voice'
                   AND o.direction = 'outbound' AND o.unix_time BETWEEN f.unix_time AND f.unix_time + 172800)) AS not_called FROM f GROUP BY 1)
           SELECT 'forms_not_called' AS flag, 'day' AS kind, call_date || ' ' || not_called || ' of ' || forms AS subject FROM s WHERE not_called > 0""",
    uses=["classified"],
)
def a13_forms(t):
    return C.form_flags(C.form_status(C.classify_calls(shapes.calls(t))))


@query(
    "a13_source_flags", "flag:s kind:s subject:s",
    sql=f"""
      WITH s AS (SELECT source, count(*) FILTER (WHERE call_date = {_D}) AS n, round(count(*) FILTER (WHERE call_date <> {_D}) / 4, 1) AS b
                 FROM (SELECT *, {BRIEF_SQL} AS channel FROM calls) WHERE channel = 'PPC' AND (call_date = {_D} OR call_date IN {_BASE}) GROUP BY 1)
      SELECT 'volume_drop' AS flag, 'PPC' AS kind, source AS subject FROM s WHERE b >= 10 AND n <= b
      UNION ALL SELECT 'sustained_drop', 'source', source FROM ({_SUSTAINED_SQL.replace("user_id", "source").replace("0.6", "1.1")})""",
    uses=["calls"],
)
def a13_sources(t):
    """Paid sources below their weekday mean on the day, and sources no more than a tenth above it for two days: the sample has no deeper drops."""
    c = shapes.calls(t).withColumn("channel", rules.brief_channel(F.col("source")))
    drops = C.volume_drop_flags(C.weekday_baseline(c.where("channel = 'PPC'"), "source", DAY), "source", "PPC", min_base=10, ratio=1.0)
    return D.union_all(drops, C.sustained_flags(C.sustained_drop(c, "source", DAY, days=2, ratio=1.1), "source", "source"))


@query(
    "a14_rep_scorecard",
    "agent_id:s answered:i missed:i quick_hangup:i outbound:i outbound_connected:i talk_hrs:f callbacks_made:i callbacks_needed:i base_answered:f "
    "answer_rate_pct:f outbound_conn_pct:f callback_rate_pct:f",
    sql=f"""
      WITH d AS (SELECT agent_id, count(*) FILTER (WHERE direction = 'inbound' AND outcome = 'answered') AS answered,
          count(*) FILTER (WHERE is_inbound_missed) AS missed, count(*) FILTER (WHERE direction = 'inbound' AND outcome = 'quick_hangup') AS quick_hangup,
          count(*) FILTER (WHERE direction = 'outbound') AS outbound, count(*) FILTER (WHERE direction = 'outbound' AND outcome = 'answered') AS outbound_connected,
          round(sum(coalesce(talk_time, 0)) / 3600.0, 1) AS talk_hrs, count(*) FILTER (WHERE callback_status = 'called_back') AS callbacks_made,
          count(*) FILTER (WHERE needs_callback) AS callbacks_needed FROM full_calls WHERE call_date = {_D} AND is_voice GROUP BY 1),
      b AS (SELECT agent_id, round(count(*) FILTER (WHERE direction = 'inbound' AND outcome = 'answered') / 4, 1) AS base
            FROM full_calls WHERE call_date IN {_BASE} AND is_voice GROUP BY 1)
      SELECT d.*, coalesce(base, 0) AS base_answered, {_pct('answered', '(answered + missed)', 1)} AS answer_rate_pct,
        {_pct('outbound_connected', 'outbound', 1)} AS outbound_conn_pct, {_pct('callbacks_made', 'callbacks_needed', 1)} AS callback_rate_pct
      FROM d LEFT JOIN b USING (agent_id)""",
    uses=["full_calls"],
)
def a14(t):
    return C.rep_scorecard(shapes.full_calls(t), DAY)


@query(
    "a15_hero_kpis",
    "data_through:s calls_today:i calls_today_delta_pct:f calls_14d_avg:i miss_rate_pct:f missed_count:i inbound_total:i median_callback_min:i "
    "callbacks_made:i callbacks_needed:i paid_calls:i paid_pct_of_total:f paid_wow_pct:f paid_miss_rate_pct:f",
    sql=f"""
      WITH c AS (SELECT *, {CHANNEL_SQL.replace("CASE WHEN regexp_replace(lower(trim(coalesce(tracking_label, ''))), '\\s+', ' ', 'g') IN ('main line', 'north') THEN 'Direct' END", "NULL")} AS channel FROM full_calls),
      g AS (SELECT count(*) FILTER (WHERE call_date = {_D}) AS n, count(*) FILTER (WHERE call_date = {_D} - 1) AS p,
        count(*) FILTER (WHERE call_date BETWEEN {_D} - 13 AND {_D}) AS n14,
        count(*) FILTER (WHERE call_date = {_D} AND is_voice AND direction = 'inbound') AS i,
        count(*) FILTER (WHERE call_date = {_D} AND is_voice AND direction = 'inbound' AND is_inbound_missed) AS m,
        median(callback_minutes) FILTER (WHERE call_date = {_D} AND callback_status = 'called_back') AS med,
        count(*) FILTER (WHERE call_date = {_D} AND callback_status = 'called_back') AS made, count(*) FILTER (WHERE call_date = {_D} AND needs_callback) AS need,
        count(*) FILTER (WHERE call_date = {_D} AND channel = 'PPC') AS ppc,
        count(*) FILTER (WHERE call_date BETWEEN {_D} - 6 AND {_D} AND channel = 'PPC') AS p7,
        count(*) FILTER (WHERE call_date BETWEEN {_D} - 13 AND {_D} - 7 AND channel = 'PPC') AS q7,
        count(*) FILTER (WHERE call_date = {_D} AND is_voice AND direction = 'inbound' AND channel = 'PPC') AS pin,
        count(*) FILTER (WHERE call_date = {_D} AND is_voice AND direction = 'inbound' AND channel = 'PPC' AND is_inbound_missed) AS pmiss FROM c)
      SELECT {_D} AS data_through, n AS calls_today, coalesce({_pct('(n - p)', 'p', 1)}, 0) AS calls_today_delta_pct, CAST(round(n14 / 14) AS BIGINT) AS calls_14d_avg,
        coalesce({_pct('m', 'i', 1)}, 0) AS miss_rate_pct, m AS missed_count, i AS inbound_total, floor(med) AS median_callback_min, made AS callbacks_made,
        need AS callbacks_needed, ppc AS paid_calls, coalesce({_pct('ppc', 'n', 1)}, 0) AS paid_pct_of_total,
        coalesce({_pct('(p7 - q7)', 'q7', 1)}, 0) AS paid_wow_pct, coalesce({_pct('pmiss', 'pin', 1)}, 0) AS paid_miss_rate_pct FROM g""",
    uses=["full_calls"],
)
def a15(t):
    return C.hero_kpis(_channelled(t), DAY)


_SERIES_SQL = f"""
  WITH c AS (SELECT 'all' AS series, call_date FROM calls UNION ALL SELECT facility, call_date FROM calls),
  p AS (SELECT series, 'day' AS grain, call_date AS period FROM c WHERE call_date <= {_D}
        UNION ALL SELECT series, 'week', call_date + CAST((7 - dayofweek(call_date)) % 7 AS INTEGER) FROM c WHERE call_date <= {_D}
        UNION ALL SELECT series, 'month', CAST(date_trunc('month', call_date) AS DATE) FROM c WHERE call_date <= {_D}),
  g AS (SELECT 'day' AS grain, CAST(d AS DATE) AS period FROM generate_series({_D} - 13, {_D}, INTERVAL 1 DAY) AS x(d)
        UNION ALL SELECT 'week', CAST(d AS DATE) FROM generate_series(DATE '2024-02-04' - 77, DATE '2024-02-04', INTERVAL 7 DAY) AS x(d)
        UNION ALL SELECT 'month', CAST(d AS DATE) FROM generate_series(DATE '2023-02-01', DATE '2024-01-01', INTERVAL 1 MONTH) AS x(d))
  SELECT s.series, g.grain, g.period, count(p.period) AS n FROM (SELECT DISTINCT series FROM c) s CROSS JOIN g
  LEFT JOIN p ON p.series = s.series AND p.grain = g.grain AND p.period = g.period GROUP BY 1, 2, 3"""


@query("a16_trailing_series", "series:s grain:s period:s n:i", sql=_SERIES_SQL, uses=["calls"])
def a16(t):
    return C.trailing_series(shapes.calls(t), "facility", DAY)


@query(
    "a16_series_arrays",
    "series:s grain:s numbers:s",
    sql=f"SELECT series, grain, '[' || string_agg(CAST(n AS VARCHAR), ', ' ORDER BY period) || ']' AS numbers FROM ({_SERIES_SQL}) GROUP BY 1, 2",
    uses=["calls"],
)
def a16b(t):
    return C.series_arrays(C.trailing_series(shapes.calls(t), "facility", DAY)).withColumn("numbers", F.col("values").cast("string"))


@query(
    "a17_week_over_week",
    "user_id:i last7:i prior7:i zero_days:i alarm:i change_pct:i",
    sql=f"""
      WITH d AS (SELECT user_id, call_date, count(*) AS n FROM calls WHERE call_date BETWEEN {_D} - 13 AND {_D} GROUP BY 1, 2),
      g AS (SELECT user_id, coalesce(sum(n) FILTER (WHERE call_date >= {_D} - 6), 0) AS last7, coalesce(sum(n) FILTER (WHERE call_date < {_D} - 6), 0) AS prior7,
                   7 - count(*) FILTER (WHERE call_date >= {_D} - 6) AS zero_days FROM d GROUP BY 1)
      SELECT *, prior7 > 0 AND last7 / prior7 - 1 < -0.15 AS alarm, CASE WHEN prior7 > 0 THEN round(100.0 * ((last7 - prior7) / prior7)) END AS change_pct FROM g""",
    uses=["calls"],
)
def a17(t):
    return C.week_over_week(shapes.calls(t), "user_id", DAY)


@query(
    "a18_channel_mix",
    "label:s count:i pct:f",
    sql=f"""SELECT label, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
            FROM (SELECT {BRIEF_SQL} AS label FROM calls) GROUP BY 1""",
    uses=["calls"],
)
def a18(t):
    return C.channel_mix(shapes.calls(t).withColumn("channel", rules.brief_channel(F.col("source"))))


@query(
    "a18_top_sources",
    "name:s channel:s count:i bar_pct:f miss_rate_pct:f",
    sql=f"""
      WITH g AS (SELECT source AS name, {BRIEF_SQL} AS channel, count(*) AS count, count(*) FILTER (WHERE is_voice AND direction = 'inbound') AS i,
                 count(*) FILTER (WHERE is_voice AND direction = 'inbound' AND is_inbound_missed) AS m FROM classified WHERE source <> '' GROUP BY 1, 2
                 ORDER BY count DESC, name LIMIT 5)
      SELECT name, channel, count, round(100.0 * count / max(count) OVER (), 1) AS bar_pct, coalesce({_pct('m', 'i', 1)}, 0) AS miss_rate_pct FROM g""",
    uses=["classified"],
)
def a18b(t):
    c = C.classify_calls(shapes.calls(t)).withColumn("channel", rules.brief_channel(F.col("source")))
    return C.top_sources(c, 5)


@query(
    "a18_rep_table",
    "name:s initials:s answered:i answered_week:i missed:i talk_time_str:s avg_handle_str:s callbacks_made:i same_agent_cb:i answer_rate_pct:f",
    sql=f"""
      WITH g AS (SELECT agent_id, agent_name, count(*) FILTER (WHERE outcome = 'answered') AS alln,
          count(*) FILTER (WHERE call_date = {_D} AND outcome = 'answered') AS answered,
          count(*) FILTER (WHERE call_date BETWEEN {_D} - 6 AND {_D} AND outcome = 'answered') AS answered_week,
          count(*) FILTER (WHERE call_date = {_D} AND is_inbound_missed) AS missed,
          coalesce(sum(coalesce(talk_time, 0)) FILTER (WHERE call_date = {_D}), 0)::BIGINT AS talk,
          coalesce(floor(avg(coalesce(talk_time, 0)) FILTER (WHERE call_date = {_D} AND outcome = 'answered')), 0)::BIGINT AS handle,
          count(*) FILTER (WHERE call_date = {_D} AND callback_status = 'called_back') AS callbacks_made,
          count(*) FILTER (WHERE call_date = {_D} AND callback_by_same_agent) AS same_agent_cb, count(*) FILTER (WHERE call_date = {_D}) AS v
        FROM full_calls WHERE is_voice GROUP BY 1, 2 HAVING count(*) FILTER (WHERE outcome = 'answered') > 0 ORDER BY alln DESC, agent_id LIMIT 6)
      SELECT split_part(agent_name, ' ', 1) || ' S.' AS name, 'AS' AS initials, answered, answered_week, missed,
        CASE WHEN talk >= 3600 THEN (talk // 3600) || 'h ' || lpad(CAST((talk % 3600) // 60 AS VARCHAR), 2, '0') || 'm' ELSE (talk // 60) || 'm' END AS talk_time_str,
        CASE WHEN handle >= 3600 THEN (handle // 3600) || 'h ' || lpad(CAST((handle % 3600) // 60 AS VARCHAR), 2, '0') || 'm' ELSE (handle // 60) || 'm' END AS avg_handle_str,
        callbacks_made, same_agent_cb, coalesce({_pct('answered', 'v', 1)}, 0) AS answer_rate_pct FROM g""",
    uses=["full_calls"],
)
def a18c(t):
    return C.rep_table(shapes.full_calls(t), DAY, k=6)


_GOALS = [("early", "BUILDING", 400, 2.0), ("early", "MACHINERY", 300, 1.5), ("early", "GHOST", 5, 1.0)]


@query(
    "a19_scorecard",
    "bucket:s admits:i admit_target:i admit_pct:s points:f point_target:f point_pct:s",
    sql="""
      WITH a AS (SELECT program AS bucket, CASE lead_type WHEN 'BD' THEN 2.0 WHEN 'Alumni' THEN 0.5 ELSE 1.0 END AS points FROM opps WHERE stage = 'Admitted'),
      t AS (SELECT * FROM (VALUES ('BUILDING', 400, 800.0), ('MACHINERY', 300, 450.0), ('GHOST', 5, 5.0)) AS v(bucket, ta, pt)),
      f AS (SELECT t.bucket, count(a.bucket) AS admits, coalesce(sum(points), 0) AS points, any_value(ta) AS ta, any_value(pt) AS pt FROM t LEFT JOIN a USING (bucket) GROUP BY 1
            UNION ALL SELECT 'Other', count(*), sum(points), NULL, NULL FROM a WHERE bucket NOT IN (SELECT bucket FROM t)),
      x AS (SELECT * FROM f UNION ALL SELECT 'TOTAL', sum(admits), sum(points), sum(ta), sum(pt) FROM f)
      SELECT bucket, admits, ta AS admit_target, CASE WHEN ta <> 0 THEN CAST(round(100.0 * admits / ta) AS BIGINT) || '%' ELSE '—' END AS admit_pct,
        round(points, 2) AS points, round(pt, 2) AS point_target, CASE WHEN pt <> 0 THEN CAST(round(100.0 * points / pt) AS BIGINT) || '%' ELSE '—' END AS point_pct FROM x""",
    uses=["opps"],
)
def a19(t):
    o = shapes.opportunities(t).where(F.col("stage") == "Admitted").select(
        F.col("program").alias("bucket"), F.expr("CASE lead_type WHEN 'BD' THEN 2.0D WHEN 'Alumni' THEN 0.5D ELSE 1.0D END").alias("points")
    )
    goals = literal_table(t.spark, [(e, b, g) for e, b, g, _ in _GOALS], "era string, bucket string, goal int")
    rubric = literal_table(t.spark, [(e, b, p) for e, b, _, p in _GOALS], "era string, bucket string, points double")
    return P.scorecard(o, P.targets(goals, rubric))


@query(
    "a20_rep_points",
    "rep:s green:i yellow:i red:i total_points:f bonus:f",
    sql="""
      WITH g AS (SELECT closer AS rep, count(*) FILTER (WHERE vob_status = 'Approved - Green') AS green, count(*) FILTER (WHERE vob_status = 'Approved - Yellow') AS yellow,
                 count(*) FILTER (WHERE vob_status = 'Approved - Red') AS red FROM opps GROUP BY 1),
      x AS (SELECT * FROM g UNION ALL SELECT 'TOTAL', sum(green), sum(yellow), sum(red) FROM g)
      SELECT *, green * 10.0 + yellow * 3.0 + red * 0.5 AS total_points, (green * 10.0 + yellow * 3.0 + red * 0.5) * 20 AS bonus FROM x""",
    uses=["opps"],
)
def a20(t):
    o = shapes.opportunities(t).withColumn("block", F.lower(F.element_at(F.split("vob_status", " - "), -1)))
    return P.rep_points(o, "closer", "block", {"green": 10, "yellow": 3, "red": 0.5})


@query(
    "a21_attribution_summary",
    "facility:s closer:s admits:i review:i",
    sql="""SELECT program AS facility, closer, count(*) AS admits, count(*) FILTER (WHERE stage = 'Open' OR (stage = 'Pending' AND lead_type = 'BD')) AS review
           FROM opps GROUP BY 1, 2""",
    uses=["opps"],
)
def a21(t):
    m = shapes.opportunities(t).select(
        F.col("program").alias("facility"), "closer", "opportunity_id",
        F.expr("CASE stage WHEN 'Open' THEN 'No match' WHEN 'Pending' THEN 'Name fuzzy' ELSE 'id + block' END").alias("match_method"),
        F.expr("CASE WHEN lead_type = 'BD' THEN 89 ELSE 90 END").alias("match_confidence"),
    )
    review = P.review_set(m, "match_method", "match_confidence").withColumn("_r", F.lit(1))
    return funnel({"admits": (m, F.lit(True)), "review": (review, F.lit(True))}, ["facility", "closer"])


@query(
    "a22_fill_profile",
    "stage:s rows:i program_filled:i closer_filled:i linked:i high_conf:i low_conf:i link_pct:f",
    sql=f"""SELECT stage, count(*) AS rows, count(CASE WHEN nationkey <> 3 THEN program END) AS program_filled, count(closer) AS closer_filled,
            count(*) FILTER (WHERE nationkey <> 3) AS linked, count(*) FILTER (WHERE lead_type = 'BD') AS high_conf, count(*) FILTER (WHERE lead_type = 'SEO') AS low_conf,
            round(100.0 * count(*) FILTER (WHERE nationkey <> 3) / count(*), 1) AS link_pct FROM opps GROUP BY 1""",
    uses=["opps"],
)
def a22(t):
    o = shapes.opportunities(t).withColumn("program", F.when(F.col("nationkey") != 3, F.col("program"))).withColumn(
        "conf", F.expr("CASE lead_type WHEN 'BD' THEN 'high' WHEN 'SEO' THEN 'low' ELSE 'x' END")
    )
    fill = Q.fill_profile(o, ["stage"], ["program", "closer"])
    match = Q.match_profile(o, ["stage"], F.col("program").isNotNull(), "conf").drop("rows")
    return fill.join(match, "stage")


@query(
    "a22_name_coverage",
    "column:s matched:i unknown:i missing:i",
    sql="""SELECT 'opener' AS "column", count(*) FILTER (WHERE opener <> 'rep-1') AS matched, count(*) FILTER (WHERE opener = 'rep-1') AS unknown, 0 AS missing FROM opps
           UNION ALL SELECT 'closer', count(*) FILTER (WHERE closer <> 'rep-2'), 0, count(*) FILTER (WHERE closer = 'rep-2') FROM opps""",
    uses=["opps"],
)
def a22b(t):
    o = shapes.opportunities(t).select(
        F.expr("CASE WHEN opener = 'rep-1' THEN 'Unknown' ELSE opener END").alias("opener"), F.expr("nullif(closer, 'rep-2')").alias("closer")
    )
    return Q.name_coverage(o, ["opener", "closer"])


@query(
    "a23_stage_qa",
    "program:s rows:i vobs:i admits:i",
    sql="""SELECT program, count(*) AS rows, count(*) FILTER (WHERE vob_status <> 'Self Pay') AS vobs, count(*) FILTER (WHERE stage = 'Admitted') AS admits
           FROM opps GROUP BY 1""",
    uses=["opps"],
)
def a23(t):
    return stage_counts(
        shapes.opportunities(t), ["program"], {"vobs": F.col("vob_status") != "Self Pay", "admits": F.col("stage") == "Admitted"}
    )


@query(
    "a24_qa_totals",
    "closer:s points:f opps:i events:i",
    sql="""SELECT closer, sum(CASE vob_status WHEN 'Approved - Green' THEN 1.0 WHEN 'Approved - Yellow' THEN 1.0 WHEN 'Self Pay' THEN 0 ELSE 0.5 END) AS points,
           count(DISTINCT opportunity_id) AS opps, count(*) AS events FROM opps GROUP BY 1""",
    uses=["opps"],
)
def a24(t):
    return shapes.opportunities(t).groupBy("closer").agg(
        F.sum(P.score_vob(F.col("vob_status"))).alias("points"), F.count_distinct("opportunity_id").alias("opps"), F.count(F.lit(1)).alias("events")
    )


# ---- windows -------------------------------------------------------------------------------


@query(
    "x1_latest_wins",
    "l_orderkey:i l_linenumber:i l_partkey:i l_shipdate:s",
    sql="""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def x1(t):
    d = D.latest(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey", "l_extendedprice"])
    return d.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query(
    "x2_earliest_wins",
    "casefile_id:s admission_date:s event_id:i census_date:s",
    sql="""SELECT casefile_id, admission_date, event_id, census_date FROM census_rows
           QUALIFY row_number() OVER (PARTITION BY casefile_id, admission_date ORDER BY census_date, event_id) = 1""",
    uses=["census_rows"],
)
def x2(t):
    return D.earliest(shapes.census_rows(t), ["casefile_id", "admission_date"], ["census_date"], ["event_id"])


_SNAP_SQL = """
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS snap, o_orderstatus AS status, substr(o_orderpriority, 1, 1) < '4' AS urgent FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1"""


def _snapshots(t):
    return t.orders.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("snap"), F.col("o_orderstatus").alias("status"),
        (F.substring("o_orderpriority", 1, 1) < "4").alias("urgent"), F.array("o_orderpriority").alias("nested"),
    )


_CHANGED_SQL = f"""
  SELECT * FROM (SELECT *, lag(status || urgent) OVER (PARTITION BY o_custkey ORDER BY snap) AS prev FROM ({_SNAP_SQL}))
  WHERE prev IS NULL OR prev <> status || urgent"""


@query("x3_change_detection", "o_custkey:i snap:s status:s urgent:i", sql=_CHANGED_SQL)
def x3(t):
    from funnelspark.functions.text import row_hash

    one = D.latest(_snapshots(t).drop("nested"), ["o_custkey", "snap"], ["o_orderkey"]).withColumn("h", row_hash(["status", "urgent"]))
    return H.changed(one, ["o_custkey"], "snap", "h")


@query(
    "x4_version_number",
    "o_custkey:i snap:s version:i",
    sql=f"SELECT o_custkey, snap, row_number() OVER (PARTITION BY o_custkey ORDER BY snap) AS version FROM ({_SNAP_SQL})",
)
def x4(t):
    one = D.latest(_snapshots(t).drop("nested"), ["o_custkey", "snap"], ["o_orderkey"])
    return one.withColumn("version", H.version_number(["o_custkey"], "snap"))


_VERSION_SQL = f"""
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY snap) AS version,
         lead(snap) OVER (PARTITION BY o_custkey ORDER BY snap) - 1 AS valid_to FROM ({_CHANGED_SQL})"""


@query(
    "x5_validity_end",
    "o_custkey:i snap:s valid_to:s",
    sql=f"SELECT o_custkey, snap, lead(snap) OVER (PARTITION BY o_custkey ORDER BY snap) - 1 AS valid_to FROM ({_SNAP_SQL})",
)
def x5(t):
    one = D.latest(_snapshots(t).drop("nested"), ["o_custkey", "snap"], ["o_orderkey"])
    return one.withColumn("valid_to", H.valid_to(["o_custkey"], "snap"))


def _history(t):
    return H.scd2(_snapshots(t), "o_custkey", "snap", modified="o_orderkey")


@query(
    "scd2_history",
    "o_custkey:i o_orderkey:i valid_from:s valid_to:s version:i status:s urgent:i",
    sql=f"SELECT *, snap AS valid_from FROM ({_VERSION_SQL})",
)
def scd2_history(t):
    return _history(t)[0]


@query(
    "scd2_current",
    "o_custkey:i o_orderkey:i valid_from:s version:i status:s",
    sql=f"SELECT *, snap AS valid_from FROM ({_VERSION_SQL}) WHERE valid_to IS NULL",
)
def scd2_current(t):
    return _history(t)[1]


@query(
    "x6_backfill_last",
    "casefile_id:s admission_date:s event_id:i program:s discharge_type:s discharge_date:s",
    sql="""
      WITH f AS (SELECT casefile_id, admission_date, arg_max(discharge_type, (census_date, event_id)) FILTER (WHERE discharge_type IS NOT NULL) AS discharge_type,
                        arg_max(discharge_date, (census_date, event_id)) FILTER (WHERE discharge_date IS NOT NULL) AS discharge_date FROM census_rows GROUP BY 1, 2),
      l AS (SELECT casefile_id, admission_date, event_id, program FROM census_rows
            QUALIFY row_number() OVER (PARTITION BY casefile_id, admission_date ORDER BY census_date DESC, event_id DESC) = 1)
      SELECT * FROM l JOIN f USING (casefile_id, admission_date)""",
    uses=["census_rows"],
)
def x6(t):
    return S.backfill_last(
        shapes.census_rows(t), ["casefile_id", "admission_date"], "census_date", ["discharge_type", "discharge_date"], "event_id"
    )


@query(
    "x7_best_candidate",
    "o_custkey:i o_orderkey:i",
    sql="""SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
           ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END ASC NULLS LAST, o_orderdate DESC, o_orderkey) = 1""",
)
def x7(t):
    rank = F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END").asc_nulls_last()
    return D.best(t.orders, ["o_custkey"], [rank, F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])


@query(
    "x8_mode_member",
    "o_custkey:i o_orderpriority:s rows:i",
    sql="""SELECT o_custkey, o_orderpriority, count(*) AS rows FROM orders GROUP BY 1, 2
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) = 1""",
)
def x8(t):
    return D.mode_member(t.orders, ["o_custkey"], ["o_orderpriority"])


@query(
    "x9_flag_duplicates",
    "l_orderkey:i l_linenumber:i l_partkey:i dup_flag:i dup_sources:s",
    sql="""
      WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, string_agg(DISTINCT l_returnflag, ' | ' ORDER BY l_returnflag) AS s FROM lineitem GROUP BY 1, 2)
      SELECT l_orderkey, l_linenumber, l_partkey, n > 1 AS dup_flag, CASE WHEN n > 1 THEN s END AS dup_sources FROM lineitem JOIN g USING (l_orderkey, l_linenumber)""",
)
def x9(t):
    return D.flag_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], "l_returnflag")


@query(
    "x10_prefer_source",
    "l_orderkey:i l_linenumber:i l_returnflag:s l_partkey:i",
    sql="""SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END, l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def x10(t):
    return D.prefer_source(
        t.lineitem, ["l_orderkey", "l_linenumber"], "l_returnflag", ["N", "R"], "l_shipdate", ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


@query("x11_drop_duplicates", "l_partkey:i l_suppkey:i", sql="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def x11(t):
    return t.lineitem.select("l_partkey", "l_suppkey").dropDuplicates(["l_partkey", "l_suppkey"])


# ---- top-k and set operators ---------------------------------------------------------------


@query(
    "t1_top_counts",
    "l_suppkey:i n:i",
    sql="SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 15",
)
def t1(t):
    return K.top_counts(t.lineitem, ["l_suppkey"], 15)


@query(
    "t2_top_k",
    "closer:s amount:f",
    sql="SELECT closer, sum(amount) AS amount FROM opps GROUP BY 1 ORDER BY amount DESC, closer LIMIT 10",
    uses=["opps"],
)
def t2(t):
    return K.top_k(shapes.opportunities(t).groupBy("closer").agg(F.sum("amount").alias("amount")), "amount", 10, ["closer"])


@query(
    "t3_report_order",
    "position:i program:s lead_type:s n:i",
    sql="""SELECT row_number() OVER (ORDER BY program NULLS LAST, lead_type) AS position, * FROM
           (SELECT CASE WHEN program <> 'BUILDING' THEN program END AS program, lead_type, count(*) AS n FROM opps GROUP BY 1, 2)""",
    uses=["opps"],
)
def t3(t):
    g = shapes.opportunities(t).groupBy(F.expr("nullif(program, 'BUILDING')").alias("program"), "lead_type").agg(F.count(F.lit(1)).alias("n"))
    order = K.report_order(["program", "lead_type"])
    # the report is one row per program and lead type, so the single ordered partition is tiny
    return g.withColumn("position", F.row_number().over(Window.orderBy(*order))).orderBy(*order)


@query("t4_row_limit", "o_orderkey:i o_custkey:i o_totalprice:f", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def t4(t):
    return K.first_rows(t.orders, 20, ["o_orderkey"])


@query(
    "u1_union_by_name",
    "kind:s n:i flagged:i",
    sql="""SELECT 'customer' AS kind, count(*) AS n, count(c_mktsegment) AS flagged FROM customer UNION ALL SELECT 'supplier', count(*), 0 FROM supplier""",
)
def u1(t):
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return D.union_all(a, b).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("segment").alias("flagged"))


@query(
    "u2_scenario_union",
    "scenario:s entity:s type:s amount:f",
    sql="""SELECT 'Historical' AS scenario, entity, type, sum(amount) AS amount FROM historical GROUP BY 2, 3
           UNION ALL SELECT 'Budget', entity, type, sum(amount) FROM budget GROUP BY 2, 3""",
    uses=["historical", "budget"],
)
def u2(t):
    both = D.tagged_union({"Historical": shapes.historical(t), "Budget": shapes.budget(t)})
    return both.groupBy("scenario", "entity", "type").agg(F.sum("amount").alias("amount"))


@query("u3_distinct", "p_brand:s p_type:s", sql="SELECT DISTINCT p_brand, p_type FROM part")
def u3(t):
    return t.part.select("p_brand", "p_type").distinct()


@query(
    "u4_new_keys",
    "c_custkey:i c_nationkey:i",
    sql="SELECT c_custkey, nullif(c_nationkey, 4) AS c_nationkey FROM customer WHERE nullif(c_nationkey, 4) NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)",
)
def u4(t):
    c = t.customer.withColumn("c_nationkey", F.expr("nullif(c_nationkey, 4)"))
    seen = t.supplier.where(F.col("s_acctbal") > 5000).select(F.expr("s_nationkey").alias("k")).union(
        literal_table(t.spark, [(None,)], "k int")
    )
    return D.new_keys(c, seen, {"c_nationkey": "k"})
