"""Measures of the report models, by name, as grouped frames (COVERAGE.md lists those not built).

Each function takes fact frames, the columns to group by and (where a measure looks back) a plain anchor date,
and returns one row per group with every measure of that model. Measures that share a fact are computed in one
aggregate; look-back measures share one scan cut to their two windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.operators import census as S
from funnelspark.operators import finance
from funnelspark.operators.measures import change, conditional, previous_period, ratio
from funnelspark.session import materialise

WINDOW_DAYS = 28


def _windows(day: Column, anchor: date) -> tuple[Column, Column, Column]:
    """(span of both windows, trailing 28 days, the 28 days before)."""
    a, b, c = (F.lit(anchor - timedelta(days=n * WINDOW_DAYS)) for n in range(3))
    return (day > c) & (day <= a), (day > b) & (day <= a), (day > c) & (day <= b)


def call_measures(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Event counts, outcomes, talk time and callback measures.

    The columns that are measured are stored first: distinct counts read them again, and callbacks are costly to find.
    """
    used = [
        "outcome", "direction", "event_type", "callback_status", "talk_time", "is_voice", "needs_callback", "callback_by_same_agent", "is_new_caller",
        "caller_number", "agent_id", "callback_minutes",
    ]
    calls = materialise(calls.select(*dict.fromkeys([*keys, *used])), "call-measures")
    o, d, kind = F.col("outcome"), F.col("direction"), F.col("event_type")
    voice = kind == "voice"
    inbound = voice & (d == "inbound")
    back = F.col("callback_status") == "called_back"
    m = conditional(
        calls,
        keys,
        sums={"total_talk_sec": (F.col("talk_time").cast("long"), F.lit(True))},
        counts={
            "total_events": F.lit(True), "voice_calls": F.col("is_voice"), "inbound_calls": inbound, "outbound_calls": voice & (d == "outbound"),
            "sms_events": kind == "sms", "form_submissions": kind == "form_fill", "answered_calls": o == "answered", "missed_calls": o == "missed",
            "voicemails": o == "voicemail", "quick_hangups": o == "quick_hangup", "abandoned_on_hold": o == "abandoned_on_hold",
            "no_contact": o == "no_contact", "inbound_answered": inbound & (o == "answered"), "needs_callback": F.col("needs_callback"),
            "called_back_any": back, "called_back_same_agent": back & F.col("callback_by_same_agent"),
            "not_called_back": F.col("callback_status") == "not_called_back", "pending_callback": F.col("callback_status") == "pending",
            "new_callers": F.col("is_new_caller"),
        },
        distinct={"unique_callers": F.col("caller_number"), "unique_agents": F.col("agent_id")},
        means={"avg_callback_min": F.when(back, F.col("callback_minutes"))},
        medians={"median_callback_min": F.when(back, F.col("callback_minutes"))},
    )
    c = F.col
    return m.withColumns(
        {
            "answer_rate": ratio(c("answered_calls"), c("voice_calls")),
            "miss_rate": ratio(c("missed_calls") + c("voicemails") + c("abandoned_on_hold"), c("inbound_calls")),
            "inbound_answer_rate": ratio(c("inbound_answered"), c("inbound_calls")),
            "total_talk_min": c("total_talk_sec") / 60,
            "total_talk_hr": c("total_talk_sec") / 3600,
            "avg_talk_min": ratio(c("total_talk_sec") / 60, c("answered_calls")),
            "callback_rate_any": ratio(c("called_back_any"), c("needs_callback")),
            "callback_rate_same_agent": ratio(c("called_back_same_agent"), c("needs_callback")),
        }
    )


def call_detail_measures(calls: DataFrame, keys: Sequence[str], day: str, anchor: date) -> DataFrame:
    """Channel split, inbound rates, trailing and prior windows of the call detail table."""
    inb, missed = F.col("direction") == "inbound", F.col("is_inbound_missed")
    ch, back = F.col("channel"), F.col("callback_status") == "called_back"
    _, now, prior = _windows(F.col(day), anchor)
    base = {
        "call_count": F.lit(True), "missed_inbound": missed, "ppc_calls": ch == "PPC", "inbound_calls": inb, "missed_inbound_calls": inb & missed,
        "answered_inbound_calls": inb & ~missed, "ppc_inbound_calls": inb & (ch == "PPC"),
    }
    counts = dict(base)
    counts |= {f"t4w_{n}": now & c for n, c in base.items()}
    counts |= {
        "p4w_call_count": prior, "new_inbound_calls": inb & F.col("is_new_caller"), "returning_inbound_calls": inb & ~F.col("is_new_caller"),
        "ppc_forms": (F.col("direction") == "form") & (ch == "PPC"), "missed_called_back": inb & missed & back, "seo_calls": inb & (ch == "SEO"),
        "brand_calls": inb & (ch == "Brand"), "direct_calls": inb & (ch == "Direct"), "_connected": F.col("callback_connected"), "_needed": F.col("needs_callback"),
    }
    m = conditional(calls, keys, counts=counts, means={"avg_talk_sec": F.col("talk_time")})
    c = F.col
    return m.withColumns(
        {
            "missed_inbound_pct": ratio(c("missed_inbound"), c("call_count")),
            "callback_connect_pct": ratio(c("_connected"), c("_needed")),
            "t4w_missed_inbound_pct": ratio(c("t4w_missed_inbound"), c("t4w_call_count")),
            "call_count_t4w_change": ratio(c("t4w_call_count") - c("p4w_call_count"), c("p4w_call_count")),
            "missed_call_pct": ratio(c("missed_inbound_calls"), c("inbound_calls")),
            "answer_rate": ratio(c("answered_inbound_calls"), c("inbound_calls")),
            "t4w_missed_call_pct": ratio(c("t4w_missed_inbound_calls"), c("t4w_inbound_calls")),
            "t4w_answer_rate": ratio(c("t4w_answered_inbound_calls"), c("t4w_inbound_calls")),
            "new_caller_pct": ratio(c("new_inbound_calls"), c("inbound_calls")),
            "callback_rate": ratio(c("missed_called_back"), c("missed_inbound_calls")),
        }
    ).drop("_connected", "_needed")


def spend_measures(spend: DataFrame, stages: DataFrame, keys: Sequence[str], day: str, anchor: date) -> DataFrame:
    """Spend, ratios and costs per stage, trailing and prior.

    ``stages`` holds (keys, day, leads, calls, forms, vobs, admits) of the paid channel. Both facts are stacked
    under one aggregate, so groups with spend but no stage (or the reverse) stay.
    """
    parts = ("cost", "impressions", "clicks", "conversions", "conversions_value")
    facts = ("leads", "calls", "forms", "vobs", "admits")

    def side(df: DataFrame, mine: Sequence[str]) -> DataFrame:
        return df.select(*keys, day, *[(F.col(n).cast("double") if n in mine else F.lit(None).cast("double")).alias(n) for n in (*parts, *facts)])

    both = side(spend, parts).unionByName(side(stages, facts))
    _, now, prior = _windows(F.col(day), anchor)
    sums = {n: (F.col(n), F.lit(True)) for n in (*parts, *facts)}
    sums |= {f"t4w_{n}": (F.col(n), now) for n in ("cost", "conversions_value", *facts)}
    sums |= {f"p4w_{n}": (F.col(n), prior) for n in ("cost", "admits")}
    m = conditional(both, keys, sums=sums)
    c = F.col
    out = {
        "ctr": ratio(c("clicks"), c("impressions")), "avg_cpc": ratio(c("cost"), c("clicks")), "roas": ratio(c("conversions_value"), c("cost")),
        "t4w_roas": ratio(c("t4w_conversions_value"), c("t4w_cost")), "cost_t4w_change": ratio(c("t4w_cost") - c("p4w_cost"), c("p4w_cost")),
        "p4w_cost_per_admit": ratio(c("p4w_cost"), c("p4w_admits")),
        "cost_per_call_or_form": ratio(c("cost"), F.coalesce("calls", F.lit(0.0)) + F.coalesce("forms", F.lit(0.0))),
    }
    for stage, label in (("admits", "admit"), ("vobs", "vob"), ("leads", "lead"), ("calls", "call")):
        out[f"cost_per_{label}"] = ratio(c("cost"), c(stage))
        out[f"t4w_cost_per_{label}"] = ratio(c("t4w_cost"), c(f"t4w_{stage}"))
    return m.withColumns(out).withColumn("cost_per_admit_t4w_change", change(c("t4w_cost_per_admit"), c("p4w_cost_per_admit")))


def funnel_measures(funnel: DataFrame, keys: Sequence[str], week: str, anchor: date) -> DataFrame:
    """Stage totals, conversion rates and their trailing and prior windows, all and paid."""
    _, now, prior = _windows(F.col(week), anchor)
    paid = F.col("lead_type") == "PPC"
    sums = {}
    for n in ("leads", "vobs", "admits"):
        v = F.col(n)
        sums |= {n: (v, F.lit(True)), f"t4w_{n}": (v, now), f"p4w_{n}": (v, prior)}
        if n != "admits":
            sums |= {f"ppc_{n}": (v, paid), f"t4w_ppc_{n}": (v, paid & now)}
    m = conditional(funnel, keys, sums=sums)
    c = F.col
    m = m.withColumns(
        {
            "lead_to_admit": ratio(c("admits"), c("leads")), "vob_to_admit": ratio(c("admits"), c("vobs")),
            "t4w_lead_to_admit": ratio(c("t4w_admits"), c("t4w_leads")), "t4w_vob_to_admit": ratio(c("t4w_admits"), c("t4w_vobs")),
            "p4w_vob_to_admit": ratio(c("p4w_admits"), c("p4w_vobs")),
        }
    )
    return m.withColumn("vob_to_admit_change_pp", F.coalesce("t4w_vob_to_admit", F.lit(0.0)) - F.coalesce("p4w_vob_to_admit", F.lit(0.0)))


def inbound_trend(calls: DataFrame, keys: Sequence[str], day: str, step: str = "week") -> DataFrame:
    """Inbound calls per week (from Monday) or month, with those of the period before and their change."""
    period = F.trunc(day, step).alias("period")
    inbound = calls.where(F.col("direction") == "inbound").groupBy(*keys, period).agg(F.count(F.lit(1)).alias("inbound_calls"))
    return previous_period(inbound, keys, "period", "inbound_calls", step)


def admit_measures(admits: DataFrame, keys: Sequence[str], day: str, anchor: date) -> DataFrame:
    """Verified admissions, all and paid, trailing, prior and change."""
    _, now, prior = _windows(F.col(day), anchor)
    paid = F.col("channel") == "PPC"
    m = conditional(
        admits, keys,
        counts={"admits": F.lit(True), "t4w_admits": now, "p4w_admits": prior, "ppc_admits": paid, "t4w_ppc_admits": paid & now, "p4w_ppc_admits": paid & prior},
    )
    return m.withColumn("t4w_change", ratio(F.col("t4w_admits") - F.col("p4w_admits"), F.col("p4w_admits")))


def verification_measures(vobs: DataFrame, keys: Sequence[str], day: str, anchor: date, failed: Column) -> DataFrame:
    """Verifications pulled, those that could not be completed, their share and the trailing count."""
    _, now, _ = _windows(F.col(day), anchor)
    m = conditional(vobs, keys, counts={"pulled": F.lit(True), "cannot_complete": failed, "t4w_pulled": now})
    return m.withColumn("cannot_complete_pct", ratio(F.col("cannot_complete"), F.col("pulled")))


def referral_measures(admits: DataFrame, keys: Sequence[str], day: str, anchor: date, targets: Mapping[str, float]) -> DataFrame:
    """Credited admissions and points with their trailing windows against the targets of the era.

    Credited: a contact is named, the bucket is not ``Other`` and the payor is not a scholarship.
    """
    who = F.coalesce(F.col("contact"), F.lit(""))
    credited = ~who.isin("", "0") & (F.col("bucket") != "Other") & (F.upper(F.coalesce("insurance", F.lit(""))) != "SCHOLARSHIP")
    _, now, _ = _windows(F.col(day), anchor)
    m = conditional(
        admits, keys, sums={"points": (F.col("points"), credited), "points_t4w": (F.col("points"), credited & now)},
        counts={"admits": credited, "admits_t4w": credited & now},
    )
    out = {}
    for n, target in (("admits", targets["admits"]), ("points", targets["points"])):
        month = F.lit(float(target))
        out |= {
            f"monthly_{n}_target": month, f"weekly_{n}_target": month / 4, f"{n}_vs_weekly": ratio(F.col(n), month / 4),
            f"{n}_t4w_vs_monthly": ratio(F.col(f"{n}_t4w"), month),
        }
    return m.withColumns(out)


def census_measures(census: DataFrame, keys: Sequence[str], week: str, day: str, anchor: date) -> DataFrame:
    """Patient days, ADC, discharges, AMA rate, stay and the trailing window, per site."""
    _, now, _ = _windows(F.col(day), anchor)
    out = F.col("discharge_date").isNotNull()
    ama = F.col("discharge_type") == "AMA"
    m = conditional(
        census, keys, counts={"census": F.lit(True), "patient_days_t4w": now},
        distinct={
            "discharges": F.when(out, F.col("casefile_id")), "ama_discharges": F.when(ama, F.col("casefile_id")),
            "unique_t4w": F.when(now, F.col("casefile_id")),
        },
    ).withColumns({"ama_rate": ratio(F.col("ama_discharges"), F.col("discharges")), "adc_t4w": F.col("patient_days_t4w") / WINDOW_DAYS})
    adc = S.average_census(S.weekly_census(census, week, day, keys), keys).drop("weeks")
    stay = S.average_stay(census, "casefile_id", "admission_date", "discharge_date", keys).drop("discharges")
    return m.join(adc, list(keys), "left").join(stay, list(keys), "left")


def cash_measures(bank: DataFrame, keys: Sequence[str], week: str) -> DataFrame:
    """Collections (all, flagged, other) and net cash flow per week with the sum of four week endings."""
    from funnelspark.operators.measures import daily_totals, rolling

    revenue = F.col("type") == "Revenue"
    flag = F.col("flag") == "VA"
    zero = F.lit(0.0)
    weekly = daily_totals(
        bank, keys, F.col(week),
        {
            "net_collections": F.when(revenue, F.col("amount")).otherwise(zero), "flagged": F.when(revenue & flag, F.col("amount")).otherwise(zero),
            "unflagged": F.when(revenue & ~flag, F.col("amount")).otherwise(zero), "net_cash_flow": F.col("amount"),
        },
    )
    return rolling(weekly, keys, ["net_collections", "net_cash_flow"], days=WINDOW_DAYS)


def finance_measures(monthly: DataFrame, budget: DataFrame, entities: Mapping[str, int], as_of: date) -> DataFrame:
    """Fiscal year-to-date revenue, wages, other and EBITDA per entity, actual and budget, with the variance."""
    def ytd(df: DataFrame, scenario: str) -> DataFrame:
        now = finance.fiscal_ytd(df, entities, as_of, ["entity", "type"], "amount")
        return now.select("entity", F.concat_ws("|", F.lit(scenario), "type").alias("line"), F.col("amount_ytd").alias("v"))

    both = ytd(monthly, "A").unionByName(ytd(budget, "B"))
    lines = {
        "revenue_ytd": "A|Revenue", "wages_ytd": "A|Salaries and Wages", "other_ytd": "A|Other Expenses", "revenue_budget_ytd": "B|Revenue",
        "wages_budget_ytd": "B|Salaries and Wages", "ebitda_budget_ytd": "B|EBITDA",
    }
    m = both.groupBy("entity").agg(*[F.sum(F.when(F.col("line") == k, F.col("v"))).alias(n) for n, k in lines.items()])
    zero = F.lit(0.0)
    m = m.withColumn("ebitda_ytd", F.coalesce("revenue_ytd", zero) - F.coalesce("wages_ytd", zero) - F.coalesce("other_ytd", zero))
    return m.withColumns(
        {
            "revenue_vs_budget": finance.growth(F.col("revenue_ytd"), F.col("revenue_budget_ytd")),
            "ebitda_vs_budget": finance.growth(F.col("ebitda_ytd"), F.col("ebitda_budget_ytd")),
        }
    )
