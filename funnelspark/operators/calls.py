"""Call-event classification, callbacks, daily statistics and dashboard series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.functions.rules import first_match
from funnelspark.functions.text import duration_text, initials, short_label
from funnelspark.operators.intervals import first_in_window

# Event types by direction, and statuses that mean no connection.
SMS_DIRECTIONS = ("msg_inbound", "msg_outbound")
NO_CONNECTION = ("no answer", "busy", "canceled", "failed", "unreachable")
MISSED_OUTCOMES = ("missed", "voicemail", "abandoned_on_hold")
QUICK_HANGUP_RING = 10
CALLBACK_MIN_SECONDS = 30
DAY = 86400


def count_where(cond: Column) -> Column:
    """Rows where the condition holds (NULL counts as no)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL where the whole is not positive."""
    return F.when(whole > 0, F.round(100.0 * part / whole, digits))


def event_type(direction: Column) -> Column:
    return first_match(
        [
            (direction.isin(*SMS_DIRECTIONS), "sms"),
            (direction == "form", "form_fill"),
            (direction == "chat", "chat"),
            (direction.isin("inbound", "outbound"), "voice"),
        ],
        "other",
    )


def outcome(direction: Column, status: Column, talk: Column, ring: Column) -> Column:
    """Ordered voice outcome; a missing talk or ring time falls through to ``other``.

    Reads the stored direction instead of the derived event type, which keeps the expression flat when the
    optimizer folds one into the other.
    """
    inbound, outbound = direction == "inbound", direction == "outbound"
    voice = direction.isin("inbound", "outbound")
    return first_match(
        [
            (voice & (status == "answered") & (talk > 0), "answered"),
            (voice & (status == "answered") & (talk == 0), "voicemail"),
            (inbound & (status == "hangup") & (ring < QUICK_HANGUP_RING), "quick_hangup"),
            (inbound & (status == "hangup") & (ring >= QUICK_HANGUP_RING), "abandoned_on_hold"),
            (inbound & status.isin(*NO_CONNECTION), "missed"),
            (outbound & status.isin(*NO_CONNECTION), "no_contact"),
        ],
        "other",
    )


def classify_calls(df: DataFrame) -> DataFrame:
    """Adds event_type, is_voice, outcome, is_inbound_missed and needs_callback."""
    d = F.col("direction")
    df = df.withColumns(
        {
            "event_type": event_type(d),
            "is_voice": F.coalesce(d.isin("inbound", "outbound"), F.lit(False)),
            "outcome": outcome(d, F.col("status"), F.col("talk_time"), F.col("ring_time")),
        }
    )
    missed = F.col("outcome").isin(*MISSED_OUTCOMES)
    return df.withColumns({"is_inbound_missed": missed, "needs_callback": missed})


def callback_bucket(status: Column, minutes: Column) -> Column:
    return first_match(
        [
            (status == "pending", "pending"),
            (status == "not_called_back", "not_called_back"),
            (minutes < 15, "<15min"),
            (minutes < 60, "15min-1hr"),
            (minutes < 1440, "1hr-24hr"),
        ],
        "1d-7d",
    )


def add_callbacks(
    calls: DataFrame, as_of_unix: int, days: int = 7, min_seconds: int = CALLBACK_MIN_SECONDS, pending_hours: int = 24
) -> DataFrame:
    """First outbound call to the same number after each call that needs one.

    ``as_of_unix`` replaces the clock: an unanswered call younger than ``pending_hours`` is pending.
    Only rows that can match (a callback is due and there is a number) enter the window; the others pass by in a union, unshuffled
    and with their columns pruned.
    """
    talk, ring = F.coalesce("talk_time", F.lit(0)), F.coalesce("ring_time", F.lit(0))
    outbound = calls.where(
        (F.col("event_type") == "voice") & (F.col("direction") == "outbound") & (talk + ring >= min_seconds)
    ).select("id", "caller_number", "unix_time", "agent_id", "outcome")
    due = F.coalesce(F.col("needs_callback"), F.lit(False)) & F.col("caller_number").isNotNull() & F.col("unix_time").isNotNull()
    matched = first_in_window(
        calls.where(due),
        outbound,
        base_key="caller_number",
        base_time=F.col("unix_time"),
        event_key="caller_number",
        event_time=F.col("unix_time"),
        event_id="id",
        carry=["agent_id", "outcome"],
        until=days * DAY,
        match="_cb",
    )
    out = matched.unionByName(calls.where(~due).withColumn("_cb", F.lit(None).cast(matched.schema["_cb"].dataType)))
    hit = F.col("_cb").isNotNull()
    status = (
        F.when(~F.col("needs_callback"), F.lit("no_callback_needed"))
        .when(hit, F.lit("called_back"))
        .when(F.col("unix_time") > as_of_unix - pending_hours * 3600, F.lit("pending"))
        .otherwise(F.lit("not_called_back"))
    )
    minutes = F.when(hit, F.floor((F.col("_cb.t") - F.col("unix_time")) / 60).cast("int"))
    both = F.col("_cb.agent_id").isNotNull() & F.col("agent_id").isNotNull()
    return (
        out.withColumns(
            {
                "callback_status": status,
                "callback_call_id": F.col("_cb.id"),
                "callback_minutes": minutes,
                "callback_by_agent_id": F.col("_cb.agent_id"),
                "callback_by_same_agent": F.when(hit & both, F.col("_cb.agent_id") == F.col("agent_id")),
                "callback_connected": F.when(hit, F.col("_cb.outcome") == "answered"),
            }
        )
        .withColumn(
            "callback_bucket",
            F.when(F.col("needs_callback"), callback_bucket(F.col("callback_status"), F.col("callback_minutes"))),
        )
        .drop("_cb")
    )


def daily_stats(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts, talk time and guarded rates per day and site."""
    o, d = F.col("outcome"), F.col("direction")
    agg = calls.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        count_where(F.col("is_voice")).alias("voice_total"),
        count_where(o == "answered").alias("voice_answered"),
        count_where(o == "missed").alias("voice_missed"),
        count_where(o == "voicemail").alias("voice_voicemail"),
        count_where(o == "quick_hangup").alias("voice_quick_hangup"),
        count_where(o == "abandoned_on_hold").alias("voice_abandoned"),
        count_where(d == "inbound").alias("inbound_total"),
        count_where(d == "outbound").alias("outbound_total"),
        count_where(F.col("event_type") == "sms").alias("sms_total"),
        count_where(F.col("event_type") == "form_fill").alias("form_total"),
        F.sum(F.coalesce("talk_time", F.lit(0)).cast("long")).alias("talk_time_seconds"),
        count_where(F.col("needs_callback")).alias("callbacks_needed"),
        count_where(F.col("callback_status") == "called_back").alias("callbacks_made_any"),
        count_where(F.col("callback_by_same_agent")).alias("callbacks_made_same_agent"),
    )
    missed = F.col("voice_missed") + F.col("voice_voicemail") + F.col("voice_abandoned")
    return (
        agg.withColumn("answer_rate_pct", pct(F.col("voice_answered"), F.col("voice_total")))
        .withColumn("miss_rate_pct", pct(missed, F.col("inbound_total")))
        .withColumn("callback_rate_any_pct", pct(F.col("callbacks_made_any"), F.col("callbacks_needed")))
        .withColumn("callback_rate_same_pct", pct(F.col("callbacks_made_same_agent"), F.col("callbacks_needed")))
    )


def agent_stats(calls: DataFrame, day: str = "call_date", agent: str = "agent_id", labels: Sequence[str] = ()) -> DataFrame:
    """Per day and agent: calls, talk time, callbacks made; ``labels`` (name, email) are carried along.

    A call yields one row for its agent and one for the agent who called back, both under one aggregate:
    one scan, one shuffle and no join of aggregates. Agents with callbacks but no own calls drop out.
    """
    def row(who: Column, own: int, answered: Column, missed: Column, talk: Column) -> Column:
        return F.struct(
            who.alias("who"), F.lit(own).alias("own"), answered.cast("int").alias("answered"), missed.cast("int").alias("missed"), talk.alias("talk"),
            *[(F.col(n) if own else F.lit(None).cast("string")).alias(n) for n in labels],
        )

    none = F.lit(0)
    mine = row(F.col(agent), 1, F.col("outcome") == "answered", F.col("is_inbound_missed"), F.coalesce("talk_time", none))
    made = row(F.col("callback_by_agent_id"), 0, none, none, none)
    rows = F.array(
        F.when(F.col(agent).isNotNull() & F.col("is_voice"), mine), F.when(F.col("callback_by_agent_id").isNotNull(), made)
    )
    agg = (
        calls.select(day, F.explode(F.array_compact(rows)).alias("r"))
        .groupBy(day, F.col("r.who").alias(agent))
        .agg(
            F.sum("r.answered").alias("calls_answered"),
            F.sum("r.missed").alias("calls_missed_assigned"),
            F.count_if(F.col("r.own") == 0).alias("callbacks_made"),
            F.sum(F.col("r.talk").cast("long")).alias("talk_time_seconds"),
            F.sum("r.own").alias("total_voice_calls"),
            *[F.max(f"r.{n}").alias(n) for n in labels],
        )
        .where("total_voice_calls > 0")
    )
    return agg.withColumn(
        "avg_talk_time_seconds",
        F.when(F.col("calls_answered") > 0, F.round(F.col("talk_time_seconds") / F.col("calls_answered"), 1)),
    ).withColumn("answer_rate_pct", pct(F.col("calls_answered"), F.col("total_voice_calls")))


def same_weekday_dates(day: date, weeks: int = 4) -> list[date]:
    return [day - timedelta(weeks=w) for w in range(1, weeks + 1)]


def weekday_baseline(
    calls: DataFrame, dim: str, report_day: date, weeks: int = 4, keep: str = "full", day: str = "call_date"
) -> DataFrame:
    """Count on the report day against the mean of the same weekday in the weeks before.

    ``keep="full"`` lists values seen on either side, ``"left"`` only those of the report day. One
    conditional aggregate over the few dates replaces two aggregates and an outer join.
    """
    base_days = same_weekday_dates(report_day, weeks)
    agg = (
        calls.where(F.col(day).isin([report_day, *base_days]) & F.col(dim).isNotNull())
        .groupBy(dim)
        .agg(
            F.count_if(F.col(day) == F.lit(report_day)).alias("calls"),
            F.round(F.count_if(F.col(day) != F.lit(report_day)) / F.lit(weeks), 1).alias("base_daily"),
        )
    )
    return agg if keep == "full" else agg.where("calls > 0")


def sustained_drop(
    calls: DataFrame,
    dim: str,
    report_day: date,
    days: int = 3,
    ratio: float = 0.60,
    base_weeks: int = 3,
    min_base: int = 2,
    day: str = "call_date",
) -> DataFrame:
    """Values at or below ``ratio`` of their weekday mean on every one of the last ``days`` days seen."""
    recent = [report_day - timedelta(days=i) for i in range(days)]
    base = same_weekday_dates(report_day, base_weeks)
    per_day = (
        calls.where(F.col(day).isin(recent + base) & F.col(dim).isNotNull())
        .groupBy(dim, day)
        .agg(F.count(F.lit(1)).alias("c"))
    )
    means = per_day.groupBy(dim).agg(
        (F.sum(F.when(F.col(day).isin(base), F.col("c")).otherwise(0)) / F.lit(base_weeks)).alias("wk_avg"),
        F.collect_list(F.when(F.col(day).isin(recent), F.col("c"))).alias("recent"),
    )
    below = F.size(F.filter("recent", lambda c: c <= F.col("wk_avg") * ratio))
    return (
        means.where(F.col("wk_avg") >= min_base)
        .select(dim, below.alias("days_below"), F.size("recent").alias("days_seen"), F.round("wk_avg", 1).alias("wk_avg"))
        .where((F.col("days_below") >= days) & (F.col("days_seen") >= days))
    )


def volume_drop_flags(baseline: DataFrame, dim: str, kind: str, min_base: float = 10, ratio: float = 0.40) -> DataFrame:
    """High-volume values whose day fell to ``ratio`` of the baseline or below."""
    return baseline.where((F.col("base_daily") >= min_base) & (F.col("calls") <= F.col("base_daily") * ratio)).select(
        F.lit("volume_drop").alias("flag"), F.lit(kind).alias("kind"), F.col(dim).cast("string").alias("subject")
    )


def sustained_flags(drops: DataFrame, dim: str, kind: str) -> DataFrame:
    return drops.select(
        F.lit("sustained_drop").alias("flag"), F.lit(kind).alias("kind"), F.col(dim).cast("string").alias("subject")
    )


def idle_rep_flags(scorecard: DataFrame, rep: str = "agent_id", min_needed: int = 2) -> DataFrame:
    """Reps with callbacks to make and none made."""
    return scorecard.where((F.col("callbacks_needed") >= min_needed) & (F.col("callbacks_made") == 0)).select(
        F.lit("no_callbacks").alias("flag"), F.lit("rep").alias("kind"), F.col(rep).cast("string").alias("subject")
    )


def form_status(calls: DataFrame, window_days: int = 2) -> DataFrame:
    """(call_date, forms, not_called): forms a day, and those whose number nobody called within the window.

    Copies of a form (number, time, source, state and label equal) count once; a form without a number cannot be called.
    """
    one = ["caller_number", "unix_time", "source", "state", "tracking_label", "call_date"]
    forms = calls.where(F.col("event_type") == "form_fill").select(*one).distinct()
    made = calls.where((F.col("event_type") == "voice") & (F.col("direction") == "outbound"))
    made = made.select(F.col("id").alias("_id"), F.col("caller_number").alias("_called"), F.col("unix_time").alias("_at"))
    seen = exists_within(forms, made, key="caller_number", event_key="_called", time="unix_time", event_time="_at", event_id="_id", seconds=window_days * DAY)
    return seen.groupBy("call_date").agg(F.count(F.lit(1)).alias("forms"), count_where(F.col("was_called") == 0).alias("not_called"))


def form_flags(status: DataFrame) -> DataFrame:
    """Days with forms that were not called back."""
    return status.where("not_called > 0").select(
        F.lit("forms_not_called").alias("flag"), F.lit("day").alias("kind"), F.concat_ws(" ", "call_date", F.format_string("%d of %d", "not_called", "forms")).alias("subject")
    )


def level_flags(totals: DataFrame, miss_pct: float = 15, median_minutes: float = 60, callback_pct: float = 50) -> DataFrame:
    """Flags of the one-row day totals: miss rate, median callback minutes, callback rate."""
    rows = F.array(
        F.struct(F.lit("miss_rate").alias("flag"), (F.col("miss_rate_pct") >= miss_pct).alias("on")),
        F.struct(F.lit("slow_callbacks").alias("flag"), (F.col("median_callback_min") > median_minutes).alias("on")),
        F.struct(F.lit("callback_rate").alias("flag"), (F.col("callback_rate_pct") < callback_pct).alias("on")),
    )
    return (
        totals.select(F.explode(rows).alias("r"))
        .where("r.on")
        .select(F.col("r.flag").alias("flag"), F.lit("day").alias("kind"), F.lit("all").alias("subject"))
    )


def rep_scorecard(calls: DataFrame, report_day: date, weeks: int = 4, rep: str = "agent_id") -> DataFrame:
    """One day's work per rep with the same-weekday answered mean, in one scan and one aggregate."""
    base = same_weekday_dates(report_day, weeks)
    today = F.col("call_date") == F.lit(report_day)
    inbound = F.col("direction") == "inbound"
    outbound = F.col("direction") == "outbound"
    answered = F.col("outcome") == "answered"
    agg = (
        calls.where(F.col("call_date").isin([report_day, *base]) & F.col("is_voice") & F.col(rep).isNotNull())
        .groupBy(rep)
        .agg(
            count_where(today).alias("_rows"),
            count_where(today & inbound & answered).alias("answered"),
            count_where(today & F.col("is_inbound_missed")).alias("missed"),
            count_where(today & inbound & (F.col("outcome") == "quick_hangup")).alias("quick_hangup"),
            count_where(today & outbound).alias("outbound"),
            count_where(today & outbound & answered).alias("outbound_connected"),
            F.round(F.sum(F.when(today, F.coalesce("talk_time", F.lit(0))).otherwise(0)) / 3600.0, 1).alias("talk_hrs"),
            count_where(today & (F.col("callback_status") == "called_back")).alias("callbacks_made"),
            count_where(today & F.col("needs_callback")).alias("callbacks_needed"),
            F.round(count_where(~today & inbound & answered) / F.lit(weeks), 1).alias("base_answered"),
        )
        .where("_rows > 0")
        .drop("_rows")
    )
    return (
        agg.withColumn("answer_rate_pct", pct(F.col("answered"), F.col("answered") + F.col("missed"), 1))
        .withColumn("outbound_conn_pct", pct(F.col("outbound_connected"), F.col("outbound"), 1))
        .withColumn("callback_rate_pct", pct(F.col("callbacks_made"), F.col("callbacks_needed"), 1))
    )


def exists_within(
    base: DataFrame, events: DataFrame, *, key: str, event_key: str, time: str, event_time: str, event_id: str,
    seconds: int, out: str = "was_called",
) -> DataFrame:
    """0/1 flag: an event of the same key falls in ``[base, base + seconds]``."""
    m = first_in_window(
        base,
        events,
        base_key=key,
        base_time=F.col(time),
        event_key=event_key,
        event_time=F.col(event_time),
        event_id=event_id,
        until=seconds,
        include_start=True,
        match="_hit",
    )
    return m.withColumn(out, F.col("_hit").isNotNull().cast("int")).drop("_hit")


def hero_kpis(calls: DataFrame, latest: date, paid: str = "PPC") -> DataFrame:
    """One row: latest day against the day before, a 14-day mean, misses, callbacks and the paid channel."""
    d = F.col("call_date")
    on, prior = d == F.lit(latest), d == F.lit(latest - timedelta(days=1))
    last7 = d.between(F.lit(latest - timedelta(days=6)), F.lit(latest))
    prior7 = d.between(F.lit(latest - timedelta(days=13)), F.lit(latest - timedelta(days=7)))
    inbound = on & F.col("is_voice") & (F.col("direction") == "inbound")
    is_paid = F.col("channel") == paid
    agg = calls.where(d.between(F.lit(latest - timedelta(days=13)), F.lit(latest))).agg(
        count_where(on).alias("calls_today"),
        count_where(prior).alias("calls_prior"),
        F.round(F.count(F.lit(1)) / 14).cast("long").alias("calls_14d_avg"),
        count_where(inbound).alias("inbound_total"),
        count_where(inbound & F.col("is_inbound_missed")).alias("missed_count"),
        # minutes are whole and bounded by the look-ahead, so the value counts stay small
        F.median(F.when(on & (F.col("callback_status") == "called_back"), F.col("callback_minutes"))).alias("_median"),
        count_where(on & (F.col("callback_status") == "called_back")).alias("callbacks_made"),
        count_where(on & F.col("needs_callback")).alias("callbacks_needed"),
        count_where(on & is_paid).alias("paid_calls"),
        count_where(last7 & is_paid).alias("_p7"),
        count_where(prior7 & is_paid).alias("_q7"),
        count_where(inbound & is_paid).alias("_pin"),
        count_where(inbound & is_paid & F.col("is_inbound_missed")).alias("_pmiss"),
    )
    zero = F.lit(0.0)
    return agg.select(
        F.lit(latest).alias("data_through"),
        "calls_today",
        F.coalesce(pct(F.col("calls_today") - F.col("calls_prior"), F.col("calls_prior"), 1), zero).alias(
            "calls_today_delta_pct"
        ),
        "calls_14d_avg",
        F.coalesce(pct(F.col("missed_count"), F.col("inbound_total"), 1), zero).alias("miss_rate_pct"),
        "missed_count",
        "inbound_total",
        F.floor("_median").cast("int").alias("median_callback_min"),
        "callbacks_made",
        "callbacks_needed",
        "paid_calls",
        F.coalesce(pct(F.col("paid_calls"), F.col("calls_today"), 1), zero).alias("paid_pct_of_total"),
        F.coalesce(pct(F.col("_p7") - F.col("_q7"), F.col("_q7"), 1), zero).alias("paid_wow_pct"),
        F.coalesce(pct(F.col("_pmiss"), F.col("_pin"), 1), zero).alias("paid_miss_rate_pct"),
    )


def trailing_series(calls: DataFrame, dim: str, latest: date, label_all: str = "all") -> DataFrame:
    """Zero-filled counts per value of ``dim`` and for all: 14 days, 12 weeks (Sunday) and 12 months.

    Each row feeds its value and the ``all`` value; the counts are aggregated before the spine, which is
    generated per value rather than joined from a date table.
    """
    last_week = latest + timedelta(days=(6 - latest.weekday()) % 7)
    months = []
    y, m = latest.year, latest.month
    for _ in range(12):
        months.append(date(y, m, 1))
        y, m = (y, m - 1) if m > 1 else (y - 1, 12)
    spine = {
        "day": [latest - timedelta(days=13 - i) for i in range(14)],
        "week": [last_week - timedelta(weeks=11 - i) for i in range(12)],
        "month": sorted(months),
    }
    d = F.col("call_date")
    first = min(spine["day"][0], spine["week"][0] - timedelta(days=6), spine["month"][0])
    week = F.date_add(d, F.pmod(F.lit(1) - F.dayofweek(d), F.lit(7)))
    daily = (
        calls.where(d.between(F.lit(first), F.lit(latest)))
        .select(d, F.explode(F.array(F.lit(label_all), F.col(dim).cast("string"))).alias("series"))
        .where("series is not null")
        .groupBy("series", "call_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    points = daily.select(
        "series",
        "n",
        F.explode(
            F.array(
                F.struct(F.lit("day").alias("grain"), d.alias("period")),
                F.struct(F.lit("week").alias("grain"), week.alias("period")),
                F.struct(F.lit("month").alias("grain"), F.trunc(d, "month").cast("date").alias("period")),
            )
        ).alias("p"),
    )
    counts = points.groupBy("series", "p.grain", "p.period").agg(F.sum("n").alias("n"))
    grid = F.array(*[F.struct(F.lit(g).alias("grain"), F.lit(x).alias("period")) for g, xs in spine.items() for x in xs])
    slots = daily.select("series").distinct().select("series", F.explode(grid).alias("s")).select(
        "series", "s.grain", "s.period", F.lit(0).cast("long").alias("n")
    )
    filled = counts.unionByName(slots).groupBy("series", "grain", "period").agg(F.sum("n").alias("n"))
    low = F.when(F.col("grain") == "day", F.lit(spine["day"][0])).when(
        F.col("grain") == "week", F.lit(spine["week"][0])
    ).otherwise(F.lit(spine["month"][0]))
    return filled.where(F.col("period") >= low)


def series_arrays(series: DataFrame) -> DataFrame:
    """One ordered array per series and grain."""
    return series.groupBy("series", "grain").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("period", "n"))), lambda x: x["n"]).alias("values")
    )


def week_over_week(calls: DataFrame, dim: str, latest: date, drop: float = -0.15) -> DataFrame:
    """Last seven days against the seven before, with the alarm flag and idle days."""
    d = F.col("call_date")
    start, mid = latest - timedelta(days=13), latest - timedelta(days=6)
    daily = (
        calls.where(d.between(F.lit(start), F.lit(latest)) & F.col(dim).isNotNull())
        .groupBy(dim, "call_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    agg = daily.groupBy(dim).agg(
        F.sum(F.when(d >= F.lit(mid), F.col("n")).otherwise(0)).alias("last7"),
        F.sum(F.when(d < F.lit(mid), F.col("n")).otherwise(0)).alias("prior7"),
        (F.lit(7) - F.count_if(d >= F.lit(mid))).cast("int").alias("zero_days"),
    )
    change = (F.col("last7") - F.col("prior7")) / F.col("prior7")
    return agg.withColumn("alarm", (F.col("prior7") > 0) & (F.col("last7") / F.col("prior7") - 1 < drop)).withColumn(
        "change_pct", F.when(F.col("prior7") > 0, F.round(100.0 * change).cast("int"))
    )


def commentary(wow: DataFrame, dim: str, order: Sequence[Column], word: str, words: str, idle_note: bool = False) -> DataFrame:
    """One text row: how many values alarm and the first three of them.

    Top three by a limit sort; the count is a global aggregate, so nothing is gathered.
    """
    drops = wow.where("alarm")
    note = F.lit("")
    if idle_note:
        note = F.when(
            F.col("zero_days") > 0,
            F.format_string(" (out %d day%s)", F.col("zero_days"), F.when(F.col("zero_days") == 1, "").otherwise("s")),
        ).otherwise("")
    bit = F.concat(F.col(dim), F.format_string(" %+d%%", F.col("change_pct")), note)
    w = Window.orderBy(*order)
    top = drops.orderBy(*order).limit(3).withColumn("_rn", F.row_number().over(w))
    bits = top.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", bit.alias("b")))), lambda x: x["b"]), " . ").alias(
            "bits"
        )
    )
    n = drops.agg(F.count(F.lit(1)).alias("n"))
    both = n.select("n", F.lit(None).cast("string").alias("bits")).unionByName(
        bits.select(F.lit(None).cast("long").alias("n"), "bits")
    )
    return both.agg(F.max("n").alias("n"), F.max("bits").alias("bits")).select(
        F.when(
            F.col("n") > 0,
            F.concat(
                F.col("n").cast("string"),
                F.lit(" "),
                F.when(F.col("n") == 1, F.lit(word)).otherwise(F.lit(words)),
                F.lit(" down sharply week over week - "),
                F.col("bits"),
            ),
        ).alias("commentary")
    )


def channel_mix(day_calls: DataFrame, by: str = "channel") -> DataFrame:
    """Share of each channel; the total is taken over the aggregated rows."""
    counts = day_calls.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(F.col(by).alias("label"), F.col("n").alias("count"), F.round(100.0 * F.col("n") / total, 1).alias("pct"))


def top_sources(day_calls: DataFrame, k: int = 10) -> DataFrame:
    """Busiest sources with a bar relative to the first and the inbound miss rate."""
    inbound = F.col("is_voice") & (F.col("direction") == "inbound")
    top = (
        day_calls.where(F.col("source").isNotNull() & (F.col("source") != ""))
        .groupBy("source", "channel")
        .agg(
            F.count(F.lit(1)).alias("count"),
            count_where(inbound).alias("_in"),
            count_where(inbound & F.col("is_inbound_missed")).alias("_miss"),
        )
        .orderBy(F.col("count").desc(), F.col("source"))
        .limit(k)
    )
    peak = F.max("count").over(Window.partitionBy(F.lit(1)))
    return top.select(
        F.col("source").alias("name"),
        "channel",
        "count",
        F.round(100.0 * F.col("count") / peak, 1).alias("bar_pct"),
        F.coalesce(pct(F.col("_miss"), F.col("_in"), 1), F.lit(0.0)).alias("miss_rate_pct"),
    )


def rep_table(calls: DataFrame, latest: date, rep: str = "agent_id", name: str = "agent_name", k: int = 10) -> DataFrame:
    """The ``k`` reps with most answered calls in the window, with today's figures as display text."""
    today = F.col("call_date") == F.lit(latest)
    week = F.col("call_date").between(F.lit(latest - timedelta(days=6)), F.lit(latest))
    answered = F.col("outcome") == "answered"
    talk = F.coalesce("talk_time", F.lit(0))
    agg = (
        calls.where(F.col(rep).isNotNull() & F.col("is_voice"))
        .groupBy(rep, name)
        .agg(
            count_where(answered).alias("_all"),
            count_where(today & answered).alias("answered"),
            count_where(week & answered).alias("answered_week"),
            count_where(today & F.col("is_inbound_missed")).alias("missed"),
            F.sum(F.when(today, talk).otherwise(0)).alias("_talk"),
            F.avg(F.when(today & answered, talk)).alias("_handle"),
            count_where(today & (F.col("callback_status") == "called_back")).alias("callbacks_made"),
            count_where(today & F.col("callback_by_same_agent")).alias("same_agent_cb"),
            count_where(today).alias("_voice"),
        )
        .where("_all > 0")
        .orderBy(F.col("_all").desc(), F.col(rep))
        .limit(k)
    )
    return agg.select(
        short_label(F.col(name)).alias("name"),
        initials(F.col(name)).alias("initials"),
        "answered",
        "answered_week",
        "missed",
        duration_text(F.col("_talk")).alias("talk_time_str"),
        duration_text(F.floor("_handle")).alias("avg_handle_str"),
        "callbacks_made",
        "same_agent_cb",
        F.coalesce(pct(F.col("answered"), F.col("_voice"), 1), F.lit(0.0)).alias("answer_rate_pct"),
    )


def payload(sections: Mapping[str, DataFrame], most_rows: int = 10_000) -> DataFrame:
    """Small report frames as one JSON document per section (section, body).

    A section is one text in one task, so one of more than ``most_rows`` rows is an error; no more than that is gathered to tell.
    """
    parts = []
    for name, df in sections.items():
        rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row")).limit(most_rows + 1)
        body = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("row")), ","), F.lit("]"))
        checked = F.when(F.count(F.lit(1)) > most_rows, F.raise_error(F.lit(f"section {name} has more than {most_rows} rows")).cast("string")).otherwise(body)
        parts.append(rows.agg(checked.alias("body")).select(F.lit(name).alias("section"), "body"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
