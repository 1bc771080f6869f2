"""Queries of the report models: every measure of a model in one frame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from funnelspark.functions import dates, rules
from funnelspark.operators import finance
from funnelspark.plans import models, shapes
from funnelspark.plans.catalog_functions import BRIEF_SQL
from funnelspark.plans.registry import query

ANCHOR = date(2024, 1, 25)
_NOW = "call_date > DATE '2023-12-28' AND call_date <= DATE '2024-01-25'"


def _n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


@query(
    "model_calls",
    "facility:s total_events:i voice_calls:i inbound_calls:i outbound_calls:i form_submissions:i answered_calls:i missed_calls:i voicemails:i quick_hangups:i "
    "abandoned_on_hold:i no_contact:i needs_callback:i called_back_any:i called_back_same_agent:i not_called_back:i pending_callback:i new_callers:i unique_callers:i "
    "unique_agents:i total_talk_sec:i answer_rate:f miss_rate:f inbound_answer_rate:f avg_talk_min:f callback_rate_any:f callback_rate_same_agent:f "
    "median_callback_min:f avg_callback_min:f",
    sql=f"""
      WITH g AS (SELECT facility, count(*) AS total_events, {_n('is_voice')} AS voice_calls, {_n("is_voice AND direction = 'inbound'")} AS inbound_calls,
        {_n("is_voice AND direction = 'outbound'")} AS outbound_calls, {_n("event_type = 'form_fill'")} AS form_submissions, {_n("outcome = 'answered'")} AS answered_calls,
        {_n("outcome = 'missed'")} AS missed_calls, {_n("outcome = 'voicemail'")} AS voicemails, {_n("outcome = 'quick_hangup'")} AS quick_hangups,
        {_n("outcome = 'abandoned_on_hold'")} AS abandoned_on_hold, {_n("outcome = 'no_contact'")} AS no_contact, {_n('needs_callback')} AS needs_callback,
        {_n("callback_status = 'called_back'")} AS called_back_any, {_n("callback_status = 'called_back' AND callback_by_same_agent")} AS called_back_same_agent,
        {_n("callback_status = 'not_called_back'")} AS not_called_back, {_n("callback_status = 'pending'")} AS pending_callback, {_n('is_new_caller')} AS new_callers,
        {_n("is_voice AND direction = 'inbound' AND outcome = 'answered'")} AS ia, count(DISTINCT caller_number) AS unique_callers, count(DISTINCT agent_id) AS unique_agents,
        sum(talk_time) AS total_talk_sec, median(callback_minutes) FILTER (WHERE callback_status = 'called_back') AS median_callback_min,
        avg(callback_minutes) FILTER (WHERE callback_status = 'called_back') AS avg_callback_min FROM full_calls GROUP BY 1)
      SELECT *, answered_calls / voice_calls AS answer_rate, (missed_calls + voicemails + abandoned_on_hold) / inbound_calls AS miss_rate, ia / inbound_calls AS inbound_answer_rate,
        total_talk_sec / 60 / answered_calls AS avg_talk_min, called_back_any / needs_callback AS callback_rate_any, called_back_same_agent / needs_callback AS callback_rate_same_agent FROM g""",
    uses=["full_calls"],
)
def model_calls(t):
    return models.call_measures(shapes.full_calls(t), ["facility"])


@query(
    "model_call_detail",
    "facility:s call_count:i t4w_call_count:i p4w_call_count:i inbound_calls:i t4w_inbound_calls:i t4w_missed_inbound_calls:i t4w_answered_inbound_calls:i "
    "ppc_calls:i t4w_ppc_calls:i ppc_inbound_calls:i t4w_ppc_inbound_calls:i ppc_forms:i new_inbound_calls:i returning_inbound_calls:i direct_calls:i missed_called_back:i "
    "missed_call_pct:f t4w_missed_call_pct:f call_count_t4w_change:f new_caller_pct:f callback_rate:f callback_connect_pct:f avg_talk_sec:f",
    sql=f"""
      WITH c AS (SELECT *, {BRIEF_SQL} AS channel FROM full_calls),
      g AS (SELECT facility, count(*) AS call_count, {_n(_NOW)} AS t4w_call_count, {_n("call_date > DATE '2023-11-30' AND call_date <= DATE '2023-12-28'")} AS p4w_call_count,
        {_n("direction = 'inbound'")} AS inbound_calls, {_n(f"direction = 'inbound' AND {_NOW}")} AS t4w_inbound_calls, {_n(f"direction = 'inbound' AND is_inbound_missed AND {_NOW}")} AS t4w_missed_inbound_calls,
        {_n(f"direction = 'inbound' AND NOT is_inbound_missed AND {_NOW}")} AS t4w_answered_inbound_calls, {_n("channel = 'PPC'")} AS ppc_calls, {_n(f"channel = 'PPC' AND {_NOW}")} AS t4w_ppc_calls,
        {_n("channel = 'PPC' AND direction = 'inbound'")} AS ppc_inbound_calls, {_n(f"channel = 'PPC' AND direction = 'inbound' AND {_NOW}")} AS t4w_ppc_inbound_calls,
        {_n("channel = 'PPC' AND direction = 'form'")} AS ppc_forms, {_n("direction = 'inbound' AND is_new_caller")} AS new_inbound_calls, {_n("direction = 'inbound' AND NOT is_new_caller")} AS returning_inbound_calls,
        {_n("direction = 'inbound' AND channel = 'Direct'")} AS direct_calls, {_n("direction = 'inbound' AND is_inbound_missed AND callback_status = 'called_back'")} AS missed_called_back,
        {_n("direction = 'inbound' AND is_inbound_missed")} AS mi, {_n('callback_connected')} AS cc, {_n('needs_callback')} AS nc, avg(talk_time) AS avg_talk_sec FROM c GROUP BY 1)
      SELECT *, mi / inbound_calls AS missed_call_pct, t4w_missed_inbound_calls / t4w_inbound_calls AS t4w_missed_call_pct, CASE WHEN p4w_call_count <> 0 THEN (t4w_call_count - p4w_call_count) / p4w_call_count END AS call_count_t4w_change,
        new_inbound_calls / inbound_calls AS new_caller_pct, missed_called_back / mi AS callback_rate, cc / nc AS callback_connect_pct FROM g""",
    uses=["full_calls"],
)
def model_call_detail(t):
    c = shapes.full_calls(t).withColumn("channel", rules.brief_channel(F.col("source")))
    return models.call_detail_measures(c, ["facility"], "call_date", ANCHOR)


_S_NOW = "day > DATE '2000-06-01' AND day <= DATE '2000-06-29'"
_S_PRI = "day > DATE '2000-05-04' AND day <= DATE '2000-06-01'"


@query(
    "model_spend",
    "account_id:i cost:f clicks:f ctr:f avg_cpc:f roas:f t4w_cost:f p4w_cost:f t4w_roas:f cost_t4w_change:f cost_per_lead:f cost_per_admit:f t4w_cost_per_admit:f p4w_cost_per_admit:f "
    "cost_per_admit_t4w_change:f cost_per_call_or_form:f t4w_cost_per_vob:f",
    sql=f"""
      WITH s AS (SELECT account_id, date AS day, * EXCLUDE (account_id, date) FROM spend),
      o AS (SELECT CAST(o_custkey % 8 AS INTEGER) AS account_id, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS st FROM orders),
      g AS (SELECT account_id, sum(cost) AS cost, sum(clicks) AS clicks, sum(impressions) AS imp, sum(conversions_value) AS cv, sum(cost) FILTER (WHERE {_S_NOW}) AS t4w_cost,
                   sum(cost) FILTER (WHERE {_S_PRI}) AS p4w_cost, sum(conversions_value) FILTER (WHERE {_S_NOW}) AS tcv FROM s GROUP BY 1),
      h AS (SELECT account_id, count(*) AS leads, {_n("st = 'F'")} AS admits, {_n(f"st = 'F' AND {_S_NOW}")} AS ta, {_n(f"st = 'F' AND {_S_PRI}")} AS pa, {_n("st = 'O'")} AS calls, {_n("st = 'P'")} AS forms,
                   {_n(f"st <> 'P' AND {_S_NOW}")} AS tv FROM o GROUP BY 1)
      SELECT account_id, cost, clicks, clicks / imp AS ctr, cost / clicks AS avg_cpc, cv / cost AS roas, t4w_cost, p4w_cost, tcv / t4w_cost AS t4w_roas, (t4w_cost - p4w_cost) / p4w_cost AS cost_t4w_change,
        cost / leads AS cost_per_lead, cost / admits AS cost_per_admit, CASE WHEN ta <> 0 THEN t4w_cost / ta END AS t4w_cost_per_admit, CASE WHEN pa <> 0 THEN p4w_cost / pa END AS p4w_cost_per_admit,
        CASE WHEN pa <> 0 THEN (coalesce(CASE WHEN ta <> 0 THEN t4w_cost / ta END, 0) - p4w_cost / pa) / (p4w_cost / pa) END AS cost_per_admit_t4w_change,
        cost / (calls + forms) AS cost_per_call_or_form, CASE WHEN tv <> 0 THEN t4w_cost / tv END AS t4w_cost_per_vob FROM g FULL OUTER JOIN h USING (account_id)""",
    uses=["spend"],
)
def model_spend(t):
    st = F.col("o_orderstatus")
    stages = t.orders.select(
        (F.col("o_custkey") % 8).cast("int").alias("account_id"), F.col("o_orderdate").cast("date").alias("day"), F.lit(1).alias("leads"),
        (st == "O").cast("int").alias("calls"), (st == "P").cast("int").alias("forms"), (st != "P").cast("int").alias("vobs"), (st == "F").cast("int").alias("admits"),
    )
    return models.spend_measures(shapes.spend(t).withColumnRenamed("date", "day"), stages, ["account_id"], "day", date(2000, 6, 29))


@query(
    "model_funnel",
    "program:s leads:i vobs:i admits:i t4w_leads:i t4w_vobs:i t4w_admits:i p4w_vobs:i p4w_admits:i ppc_leads:i t4w_ppc_vobs:i lead_to_admit:f vob_to_admit:f t4w_vob_to_admit:f p4w_vob_to_admit:f vob_to_admit_change_pp:f",
    sql=f"""
      WITH o AS (SELECT *, created_day AS day, vob_status <> 'Self Pay' AS v, stage = 'Admitted' AS a, lead_type = 'SEO' AS p FROM opps),
      g AS (SELECT program, count(*) AS leads, {_n('v')} AS vobs, {_n('a')} AS admits, {_n(_S_NOW)} AS t4w_leads, {_n(f'v AND {_S_NOW}')} AS t4w_vobs, {_n(f'a AND {_S_NOW}')} AS t4w_admits,
        {_n(f'v AND {_S_PRI}')} AS p4w_vobs, {_n(f'a AND {_S_PRI}')} AS p4w_admits, {_n('p')} AS ppc_leads, {_n(f'p AND v AND {_S_NOW}')} AS t4w_ppc_vobs FROM o GROUP BY 1)
      SELECT *, admits / leads AS lead_to_admit, admits / vobs AS vob_to_admit, CASE WHEN t4w_vobs <> 0 THEN t4w_admits / t4w_vobs END AS t4w_vob_to_admit, CASE WHEN p4w_vobs <> 0 THEN p4w_admits / p4w_vobs END AS p4w_vob_to_admit,
        coalesce(CASE WHEN t4w_vobs <> 0 THEN t4w_admits / t4w_vobs END, 0) - coalesce(CASE WHEN p4w_vobs <> 0 THEN p4w_admits / p4w_vobs END, 0) AS vob_to_admit_change_pp FROM g""",
    uses=["opps"],
)
def model_funnel(t):
    o = shapes.opportunities(t).select(
        "program", F.col("created_day").alias("day"), F.when(F.col("lead_type") == "SEO", F.lit("PPC")).otherwise(F.col("lead_type")).alias("lead_type"),
        F.lit(1).alias("leads"), (F.col("vob_status") != "Self Pay").cast("int").alias("vobs"), (F.col("stage") == "Admitted").cast("int").alias("admits"),
    )
    m = models.funnel_measures(o, ["program"], "day", date(2000, 6, 29))
    return m.na.fill(0, ["t4w_leads", "t4w_vobs", "t4w_admits", "p4w_vobs", "p4w_admits", "ppc_leads", "t4w_ppc_vobs"])


@query(
    "model_admits",
    "program:s admits:i t4w_admits:i p4w_admits:i ppc_admits:i t4w_ppc_admits:i t4w_change:f pulled:i cannot_complete:i t4w_pulled:i cannot_complete_pct:f",
    sql=f"""
      WITH o AS (SELECT *, created_day AS day, stage = 'Admitted' AS a, lead_type = 'SEO' AS p FROM opps),
      g AS (SELECT program, {_n('a')} AS admits, {_n(f'a AND {_S_NOW}')} AS t4w_admits, {_n(f'a AND {_S_PRI}')} AS p4w_admits, {_n('a AND p')} AS ppc_admits, {_n(f'a AND p AND {_S_NOW}')} AS t4w_ppc_admits,
        count(*) AS pulled, {_n("vob_status = 'Self Pay'")} AS cannot_complete, {_n(_S_NOW)} AS t4w_pulled FROM o GROUP BY 1)
      SELECT *, CASE WHEN p4w_admits <> 0 THEN (t4w_admits - p4w_admits) / p4w_admits END AS t4w_change, cannot_complete / pulled AS cannot_complete_pct FROM g""",
    uses=["opps"],
)
def model_admits(t):
    o = shapes.opportunities(t).withColumn("channel", F.when(F.col("lead_type") == "SEO", F.lit("PPC")).otherwise(F.lit("x")))
    a = models.admit_measures(o.where(F.col("stage") == "Admitted"), ["program"], "created_day", date(2000, 6, 29))
    v = models.verification_measures(o, ["program"], "created_day", date(2000, 6, 29), F.col("vob_status") == "Self Pay")
    return a.join(v, "program", "full_outer")


@query(
    "model_referrals",
    "bucket:s admits:i points:f admits_t4w:i points_t4w:f weekly_admits_target:f admits_vs_weekly:f admits_t4w_vs_monthly:f points_t4w_vs_monthly:f",
    sql=f"""
      WITH o AS (SELECT CASE program WHEN 'BUILDING' THEN 'Other' ELSE program END AS bucket, created_day AS day, amount AS points, closer NOT IN ('rep-0', 'rep-1') AND program <> 'BUILDING' AND lead_type <> 'BD' AS ok FROM opps),
      g AS (SELECT bucket, {_n('ok')} AS admits, sum(points) FILTER (WHERE ok) AS points, {_n(f'ok AND {_S_NOW}')} AS admits_t4w, sum(points) FILTER (WHERE ok AND {_S_NOW}) AS points_t4w FROM o GROUP BY 1)
      SELECT *, 10.0 AS weekly_admits_target, admits / 10.0 AS admits_vs_weekly, admits_t4w / 40.0 AS admits_t4w_vs_monthly, points_t4w / 80.0 AS points_t4w_vs_monthly FROM g""",
    uses=["opps"],
)
def model_referrals(t):
    o = shapes.opportunities(t).select(
        F.expr("CASE program WHEN 'BUILDING' THEN 'Other' ELSE program END").alias("bucket"), "created_day", F.col("amount").alias("points"),
        F.expr("CASE closer WHEN 'rep-0' THEN NULL WHEN 'rep-1' THEN '0' ELSE closer END").alias("contact"),
        F.expr("CASE lead_type WHEN 'BD' THEN 'Scholarship' ELSE lead_type END").alias("insurance"),
    )
    return models.referral_measures(o, ["bucket"], "created_day", date(2000, 6, 29), {"admits": 40, "points": 80})


@query(
    "model_census",
    "facility:s census:i patient_days_t4w:i unique_t4w:i discharges:i ama_discharges:i ama_rate:f adc_t4w:f adc:f avg_los:f",
    sql="""
      WITH g AS (SELECT facility, count(*) AS census, count(*) FILTER (WHERE census_date > DATE '2023-12-28' AND census_date <= DATE '2024-01-25') AS patient_days_t4w,
          count(DISTINCT casefile_id) FILTER (WHERE census_date > DATE '2023-12-28' AND census_date <= DATE '2024-01-25') AS unique_t4w,
          count(DISTINCT casefile_id) FILTER (WHERE discharge_date IS NOT NULL) AS discharges, count(DISTINCT casefile_id) FILTER (WHERE discharge_type = 'AMA') AS ama_discharges FROM census GROUP BY 1),
      w AS (SELECT facility, avg(x) AS adc FROM (SELECT facility, census_date + CAST(7 - dayofweek(census_date) AS INTEGER) AS week, count(*) / count(DISTINCT census_date) AS x FROM census GROUP BY 1, 2) GROUP BY 1),
      l AS (SELECT facility, avg(d - a) AS avg_los FROM (SELECT casefile_id, facility, min(admission_date) AS a, min(discharge_date) AS d FROM census GROUP BY 1, 2) WHERE d IS NOT NULL GROUP BY 1)
      SELECT g.*, ama_discharges / discharges AS ama_rate, patient_days_t4w / 28 AS adc_t4w, adc, avg_los FROM g LEFT JOIN w USING (facility) LEFT JOIN l USING (facility)""",
    uses=["census"],
)
def model_census(t):
    c = shapes.census(t).withColumn("week", dates.week_ending_strict(F.col("census_date")))
    return models.census_measures(c, ["facility"], "week", "census_date", ANCHOR)


@query(
    "model_cash",
    "entity:s day:s net_collections:f flagged:f unflagged:f net_cash_flow:f net_collections_28d:f net_cash_flow_28d:f",
    sql="""
      WITH b AS (SELECT entity, date + CAST((7 - dayofweek(date)) % 7 AS INTEGER) AS day, type, amount, entity = 'E1' AS f FROM bank),
      g AS (SELECT entity, day, coalesce(sum(amount) FILTER (WHERE type = 'Revenue'), 0) AS net_collections, coalesce(sum(amount) FILTER (WHERE type = 'Revenue' AND f), 0) AS flagged,
                   coalesce(sum(amount) FILTER (WHERE type = 'Revenue' AND NOT f), 0) AS unflagged, sum(amount) AS net_cash_flow FROM b GROUP BY 1, 2)
      SELECT *, sum(net_collections) OVER w AS net_collections_28d, sum(net_cash_flow) OVER w AS net_cash_flow_28d FROM g
      WINDOW w AS (PARTITION BY entity ORDER BY day RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW)""",
    uses=["bank"],
)
def model_cash(t):
    b = shapes.bank(t).withColumns(
        {
            "week": dates.week_ending(F.col("date"), "SUN"),
            "flag": finance.text_flag(F.when(F.col("entity") == "E1", F.lit("the va desk")).otherwise(F.lit("other")), "VA", "VA", "Non-VA"),
        }
    )
    return models.cash_measures(b, ["entity"], "week")


_YTD = """SELECT entity, type, sum(amount) AS v FROM (SELECT *, year(month_ending - to_months(CAST(s - 1 AS INTEGER))) AS fy, month(month_ending - to_months(CAST(s - 1 AS INTEGER))) AS fp,
  year(DATE '2000-06-30' - to_months(CAST(s - 1 AS INTEGER))) AS ty, month(DATE '2000-06-30' - to_months(CAST(s - 1 AS INTEGER))) AS tp
  FROM (SELECT *, CASE entity WHEN 'E1' THEN 1 WHEN 'E2' THEN 4 ELSE 10 END AS s FROM {0})) WHERE fy = ty AND fp <= tp GROUP BY 1, 2"""


@query(
    "model_finance",
    "entity:s revenue_ytd:f wages_ytd:f other_ytd:f ebitda_ytd:f revenue_budget_ytd:f ebitda_budget_ytd:f revenue_vs_budget:f ebitda_vs_budget:f",
    sql=f"""
      WITH u AS (SELECT 'A' AS k, * FROM ({_YTD.format('fin_monthly')}) UNION ALL SELECT 'B', * FROM ({_YTD.format('budget')})),
      g AS (SELECT entity, sum(v) FILTER (WHERE k = 'A' AND type = 'Revenue') AS revenue_ytd, sum(v) FILTER (WHERE k = 'A' AND type = 'Salaries and Wages') AS wages_ytd,
        sum(v) FILTER (WHERE k = 'A' AND type = 'Other Expenses') AS other_ytd, sum(v) FILTER (WHERE k = 'B' AND type = 'Revenue') AS revenue_budget_ytd,
        sum(v) FILTER (WHERE k = 'B' AND type = 'EBITDA') AS ebitda_budget_ytd FROM u GROUP BY 1),
      h AS (SELECT *, coalesce(revenue_ytd, 0) - coalesce(wages_ytd, 0) - coalesce(other_ytd, 0) AS ebitda_ytd FROM g)
      SELECT *, (revenue_ytd - revenue_budget_ytd) / abs(revenue_budget_ytd) AS revenue_vs_budget, (ebitda_ytd - ebitda_budget_ytd) / abs(ebitda_budget_ytd) AS ebitda_vs_budget FROM h""",
    uses=["fin_monthly", "budget"],
)
def model_finance(t):
    m = finance.fin_monthly(shapes.bank(t), shapes.historical(t))
    return models.finance_measures(m, shapes.budget(t), {"E1": 1, "E2": 4, "E3": 10}, date(2000, 6, 30))


def _trend_sql(step: str) -> str:
    return f"""WITH a AS (SELECT facility, CAST(date_trunc('{step}', call_date) AS DATE) AS period, count(*) AS n FROM calls WHERE direction = 'inbound' GROUP BY 1, 2)
      SELECT a.facility, a.period, a.n AS inbound_calls, b.n AS inbound_calls_prev, (a.n - b.n) / b.n AS inbound_calls_change
      FROM a LEFT JOIN a b ON a.facility IS NOT DISTINCT FROM b.facility AND CAST(b.period + INTERVAL 1 {step} AS DATE) = a.period"""


_TREND = "facility:s period:s inbound_calls:i inbound_calls_prev:i inbound_calls_change:f"


@query("model_inbound_week", _TREND, sql=_trend_sql("week"), uses=["calls"])
def model_inbound_week(t):
    return models.inbound_trend(shapes.calls(t), ["facility"], "call_date", "week")


@query("model_inbound_month", _TREND, sql=_trend_sql("month"), uses=["calls"])
def model_inbound_month(t):
    return models.inbound_trend(shapes.calls(t), ["facility"], "call_date", "month")
