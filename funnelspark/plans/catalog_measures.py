"""Queries of the measure families."""

from __future__ import annotations

from pyspark.sql import functions as F

from funnelspark.functions import dates
from funnelspark.operators import census as S
from funnelspark.operators import finance, measures as M, mergeable, scoring
from funnelspark.plans import shapes
from funnelspark.plans.registry import query
from funnelspark.session import materialise
from funnelspark.sources.tables import literal_table

_WEEK = "CAST(ts AS DATE) + CAST((4 - dayofweek(ts) + 7) % 7 AS INTEGER)"


@query(
    "m1_sums_counts", "segment:s revenue:f urgent:f orders:i",
    sql="""SELECT c_mktsegment AS segment, sum(o_totalprice) AS revenue, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent, count(*) AS orders
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def m1(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_mktsegment", "segment")
    yes = F.lit(True)
    return M.conditional(
        d, ["segment"], sums={"revenue": (F.col("o_totalprice"), yes), "urgent": (F.col("o_totalprice"), F.col("o_orderpriority") == "1-URGENT")},
        counts={"orders": yes},
    )


@query(
    "m2_filtered_counts", "facility:s total:i inbound:i missed:i answered:i forms:i new_callers:i called_back:i pending:i",
    sql="""SELECT facility, count(*) AS total, count(*) FILTER (WHERE direction = 'inbound') AS inbound, count(*) FILTER (WHERE direction = 'inbound' AND is_inbound_missed) AS missed,
           count(*) FILTER (WHERE direction = 'inbound' AND NOT is_inbound_missed) AS answered, count(*) FILTER (WHERE event_type = 'form_fill') AS forms,
           count(*) FILTER (WHERE is_new_caller) AS new_callers, count(*) FILTER (WHERE callback_status = 'called_back') AS called_back,
           count(*) FILTER (WHERE callback_status = 'pending') AS pending FROM full_calls GROUP BY 1""",
    uses=["full_calls"],
)
def m2(t):
    inb = F.col("direction") == "inbound"
    return M.conditional(
        shapes.full_calls(t), ["facility"],
        counts={
            "total": F.lit(True), "inbound": inb, "missed": inb & F.col("is_inbound_missed"), "answered": inb & ~F.col("is_inbound_missed"),
            "forms": F.col("event_type") == "form_fill", "new_callers": F.col("is_new_caller"),
            "called_back": F.col("callback_status") == "called_back", "pending": F.col("callback_status") == "pending",
        },
    )


@query(
    "m3_distinct_mean", "facility:s callers:i agents:i avg_talk:f",
    sql="SELECT facility, count(DISTINCT caller_number) AS callers, count(DISTINCT agent_id) AS agents, avg(talk_time) AS avg_talk FROM calls GROUP BY 1",
    uses=["calls"],
)
def m3(t):
    return M.conditional(
        shapes.calls(t), ["facility"], distinct={"callers": F.col("caller_number"), "agents": F.col("agent_id")}, means={"avg_talk": F.col("talk_time")}
    )


@query(
    "m3_trailing_distinct", "facility:s day:s distinct_1d:i distinct_7d:i distinct_28d:i",
    sql="""WITH d AS (SELECT DISTINCT facility, call_date FROM calls)
           SELECT d.facility, d.call_date AS day, count(DISTINCT CASE WHEN c.call_date = d.call_date THEN caller_number END) AS distinct_1d,
                  count(DISTINCT CASE WHEN c.call_date > d.call_date - 7 THEN caller_number END) AS distinct_7d, count(DISTINCT caller_number) AS distinct_28d
           FROM d JOIN calls c ON c.facility IS NOT DISTINCT FROM d.facility AND c.call_date BETWEEN d.call_date - 27 AND d.call_date GROUP BY 1, 2""",
    uses=["calls"],
)
def m3_trailing(t):
    """Callers of a day, a week and 28 days, all from one table of daily bitmaps."""
    calls = shapes.calls(t)
    ids = mergeable.dense_ids(calls, "caller_number")
    return mergeable.trailing_distinct(mergeable.daily_bitmaps(calls, ["facility"], "call_date", "caller_number", ids), ["facility"], [1, 7, 28])


@query(
    "m4_trailing_median", "facility:s day:s q_14d:f q_28d:f",
    sql="""WITH b AS (SELECT facility, call_date, callback_minutes AS m FROM full_calls WHERE callback_minutes IS NOT NULL), d AS (SELECT DISTINCT facility, call_date FROM b)
           SELECT d.facility, d.call_date AS day, median(m) FILTER (WHERE b.call_date > d.call_date - 14) AS q_14d, median(m) AS q_28d
           FROM d JOIN b ON b.facility IS NOT DISTINCT FROM d.facility AND b.call_date BETWEEN d.call_date - 27 AND d.call_date GROUP BY 1, 2""",
    uses=["full_calls"],
)
def m4_trailing(t):
    """Median callback minutes of 14 and 28 days, from one table of daily counts of whole minutes."""
    daily = mergeable.daily_histogram(shapes.full_calls(t), ["facility"], "call_date", F.col("callback_minutes"))
    return mergeable.trailing_quantile(materialise(daily, "minutes"), ["facility"], [14, 28])


@query(
    "m4_median", "facility:s median_minutes:f",
    sql="SELECT facility, median(callback_minutes) FILTER (WHERE callback_status = 'called_back') AS median_minutes FROM full_calls GROUP BY 1",
    uses=["full_calls"],
)
def m4(t):
    return M.conditional(
        shapes.full_calls(t), ["facility"], medians={"median_minutes": F.when(F.col("callback_status") == "called_back", F.col("callback_minutes"))}
    )


_DAILY_SQL = "SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS amount, count(*) AS n FROM orders GROUP BY 1, 2"


def _daily(t):
    o = t.orders.withColumnRenamed("o_orderstatus", "status")
    return M.daily_totals(o, ["status"], F.col("o_orderdate").cast("date"), {"amount": F.col("o_totalprice"), "n": F.lit(1)})


@query(
    "m5_trailing28", "status:s day:s amount_28d:f n_28d:i",
    sql=f"""SELECT status, day, sum(amount) OVER w AS amount_28d, sum(n) OVER w AS n_28d FROM ({_DAILY_SQL})
            WINDOW w AS (PARTITION BY status ORDER BY day RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW)""",
)
def m5(t):
    return M.rolling(_daily(t), ["status"], ["amount", "n"])


@query(
    "m5_trailing_latest", "segment:s amount_t:f amount_p:f amount_change:f n_t:i n_p:i",
    sql="""
      SELECT c_mktsegment AS segment, sum(o_totalprice) FILTER (WHERE o_orderdate > DATE '2000-06-01' AND o_orderdate <= DATE '2000-06-29') AS amount_t,
        sum(o_totalprice) FILTER (WHERE o_orderdate > DATE '2000-05-04' AND o_orderdate <= DATE '2000-06-01') AS amount_p,
        (amount_t - amount_p) / amount_p AS amount_change, count(*) FILTER (WHERE o_orderdate > DATE '2000-06-01' AND o_orderdate <= DATE '2000-06-29') AS n_t,
        count(*) FILTER (WHERE o_orderdate > DATE '2000-05-04' AND o_orderdate <= DATE '2000-06-01') AS n_p
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate > DATE '2000-05-04' AND o_orderdate <= DATE '2000-06-29' GROUP BY 1""",
)
def m5b(t):
    d = t.orders.withColumn("day", F.col("o_orderdate").cast("date")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return M.trailing_at(d.withColumnRenamed("c_mktsegment", "segment"), ["segment"], "day", "2000-06-29", {"amount": F.col("o_totalprice"), "n": F.lit(1)})


@query(
    "m6_prior28", "status:s day:s amount_28d_prior:f",
    sql=f"""SELECT status, day, sum(amount) OVER (PARTITION BY status ORDER BY day RANGE BETWEEN INTERVAL 55 DAY PRECEDING AND INTERVAL 28 DAY PRECEDING) AS amount_28d_prior
            FROM ({_DAILY_SQL})""",
)
def m6(t):
    return M.rolling(_daily(t), ["status"], ["amount"], lag_days=28)


@query(
    "m7_ratios", "facility:s answer_rate:f miss_rate:f callback_rate:f empty_rate:f",
    sql="""SELECT facility, count(*) FILTER (WHERE outcome = 'answered') / count(*) FILTER (WHERE is_voice) AS answer_rate,
           count(*) FILTER (WHERE is_inbound_missed) / count(*) FILTER (WHERE direction = 'inbound') AS miss_rate,
           count(*) FILTER (WHERE callback_status = 'called_back') / count(*) FILTER (WHERE needs_callback) AS callback_rate, NULL AS empty_rate FROM full_calls GROUP BY 1""",
    uses=["full_calls"],
)
def m7(t):
    m = M.conditional(
        shapes.full_calls(t), ["facility"],
        counts={"a": F.col("outcome") == "answered", "v": F.col("is_voice"), "m": F.col("is_inbound_missed"), "i": F.col("direction") == "inbound",
                "c": F.col("callback_status") == "called_back", "n": F.col("needs_callback"), "z": F.col("direction") == "nowhere"},
    )
    return m.select(
        "facility", M.ratio(F.col("a"), F.col("v")).alias("answer_rate"), M.ratio(F.col("m"), F.col("i")).alias("miss_rate"),
        M.ratio(F.col("c"), F.col("n")).alias("callback_rate"), M.ratio(F.col("a"), F.col("z")).alias("empty_rate"),
    )


@query(
    "m8_composites", "month_ending:s entity:s rev:f wages:f other:f ebitda:f",
    sql="""SELECT month_ending, entity, sum(amount) FILTER (WHERE type = 'Revenue') AS rev, sum(amount) FILTER (WHERE type = 'Salaries and Wages') AS wages,
           sum(amount) FILTER (WHERE type = 'Other Expenses') AS other, coalesce(rev, 0) - coalesce(wages, 0) - coalesce(other, 0) AS ebitda FROM fin_monthly GROUP BY 1, 2""",
    uses=["fin_monthly"],
)
def m8(t):
    return finance.metric_columns(finance.fin_monthly(shapes.bank(t), shapes.historical(t)), ["month_ending", "entity"])


@query(
    "m9_previous_week", "week:s user_id:i n:i n_prev:i n_change:f",
    sql=f"""WITH w AS (SELECT {_WEEK} AS week, user_id, count(*) AS n FROM events GROUP BY 1, 2)
            SELECT a.week, a.user_id, a.n, b.n AS n_prev, (a.n - b.n) / b.n AS n_change FROM w a LEFT JOIN w b ON a.user_id = b.user_id AND b.week = a.week - 7""",
)
def m9(t):
    w = t.events.groupBy(dates.week_ending(F.col("ts").cast("date")).alias("week"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return M.previous_period(w, ["user_id"], "week", "n", "week")


@query(
    "m9_previous_month", "month:s custkey:i n:i n_prev:i",
    sql="""WITH w AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey AS custkey, count(*) AS n FROM orders GROUP BY 1, 2)
           SELECT a.month, a.custkey, a.n, b.n AS n_prev FROM w a LEFT JOIN w b ON a.custkey = b.custkey AND b.month = CAST(a.month - INTERVAL 1 MONTH AS DATE)""",
)
def m9b(t):
    w = t.orders.groupBy(dates.month_start(F.col("o_orderdate").cast("date")).alias("month"), F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("n"))
    return M.previous_period(w, ["custkey"], "month", "n", "month")


@query(
    "m10_prior_year", "month_ending:s entity:s type:s amount:f amount_py:f yoy:f",
    sql="""WITH m AS (SELECT month_ending, entity, type, sum(amount) AS amount FROM fin_monthly GROUP BY 1, 2, 3)
           SELECT a.month_ending, a.entity, a.type, a.amount, b.amount AS amount_py, CASE WHEN b.amount <> 0 THEN (a.amount - b.amount) / abs(b.amount) END AS yoy FROM m a
           LEFT JOIN m b ON a.entity = b.entity AND a.type = b.type AND b.month_ending = last_day(CAST(a.month_ending - INTERVAL 12 MONTH AS DATE))""",
    uses=["fin_monthly"],
)
def m10(t):
    m = finance.fin_monthly(shapes.bank(t), shapes.historical(t)).groupBy("month_ending", "entity", "type").agg(F.sum("amount").alias("amount"))
    return finance.prior_year(m, ["entity", "type"], "amount").withColumn("yoy", finance.growth(F.col("amount"), F.col("amount_py")))


@query(
    "m11_fiscal_ytd", "entity:s type:s amount_ytd:f",
    sql="""
      WITH f AS (SELECT *, CASE entity WHEN 'E1' THEN 1 WHEN 'E2' THEN 4 ELSE 10 END AS s FROM fin_monthly),
      g AS (SELECT *, year(month_ending - to_months(CAST(s - 1 AS INTEGER))) AS fy, month(month_ending - to_months(CAST(s - 1 AS INTEGER))) AS fp,
                   year(DATE '2000-06-30' - to_months(CAST(s - 1 AS INTEGER))) AS ty, month(DATE '2000-06-30' - to_months(CAST(s - 1 AS INTEGER))) AS tp FROM f)
      SELECT entity, type, sum(amount) AS amount_ytd FROM g WHERE fy = ty AND fp <= tp GROUP BY 1, 2""",
    uses=["fin_monthly"],
)
def m11(t):
    m = finance.fin_monthly(shapes.bank(t), shapes.historical(t))
    return finance.fiscal_ytd(m, {"E1": 1, "E2": 4, "E3": 10}, "2000-06-30", ["entity", "type"], "amount")


_BEDS = {"F0": 17, "F1": 32, "F2": 27, "F3": 22}


@query(
    "m12_utilisation", "facility:s adc:f beds:i utilisation:f",
    sql="""
      WITH w AS (SELECT census_date + CAST(7 - dayofweek(census_date) AS INTEGER) AS week, facility, count(*) / count(DISTINCT census_date) AS adc FROM census GROUP BY 1, 2)
      SELECT facility, avg(adc) AS adc, CASE facility WHEN 'F0' THEN 17 WHEN 'F1' THEN 32 WHEN 'F2' THEN 27 WHEN 'F3' THEN 22 END AS beds,
             avg(adc) / CASE facility WHEN 'F0' THEN 17 WHEN 'F1' THEN 32 WHEN 'F2' THEN 27 WHEN 'F3' THEN 22 END AS utilisation FROM w GROUP BY 1""",
    uses=["census"],
)
def m12(t):
    c = shapes.census(t).withColumn("week", dates.week_ending_strict(F.col("census_date")))
    return S.utilisation(S.average_census(S.weekly_census(c, "week", "census_date", ["facility"]), ["facility"]), _BEDS, "facility")


@query(
    "m13_weekly_admits", "week_ending:s facility:s admits:i",
    sql="""WITH f AS (SELECT casefile_id, min(census_date) AS d, any_value(facility) AS facility FROM census GROUP BY 1)
           SELECT d + CAST((7 - dayofweek(d)) % 7 AS INTEGER) AS week_ending, facility, count(*) AS admits FROM f GROUP BY 1, 2""",
    uses=["census"],
)
def m13(t):
    return S.weekly_admits(shapes.census(t), "casefile_id", "census_date", dates.week_ending(F.col("first_day"), "SUN"), ["facility"])


@query(
    "m14_average_stay", "facility:s avg_los:f discharges:i",
    sql="""SELECT facility, avg(d - a) AS avg_los, count(*) AS discharges FROM (SELECT casefile_id, facility, min(admission_date) AS a, min(discharge_date) AS d FROM census GROUP BY 1, 2)
           WHERE d IS NOT NULL GROUP BY 1""",
    uses=["census"],
)
def m14(t):
    return S.average_stay(shapes.census(t), "casefile_id", "admission_date", "discharge_date", ["facility"])


@query(
    "m15_adc", "facility:s payor:s adc:f weeks:i",
    sql="""
      WITH c AS (SELECT *, census_date + CAST(7 - dayofweek(census_date) AS INTEGER) AS week FROM census),
      d AS (SELECT week, facility, count(DISTINCT census_date) AS dates FROM c GROUP BY 1, 2),
      n AS (SELECT week, facility, payor, count(*) AS r FROM c GROUP BY 1, 2, 3), s AS (SELECT DISTINCT facility, payor FROM c)
      SELECT d.facility, s.payor, avg(coalesce(r, 0) / dates) AS adc, count(*) AS weeks FROM d JOIN s USING (facility)
      LEFT JOIN n ON n.week = d.week AND n.facility = d.facility AND n.payor = s.payor GROUP BY 1, 2""",
    uses=["census"],
)
def m15(t):
    c = shapes.census(t).withColumn("week", dates.week_ending_strict(F.col("census_date")))
    return S.average_census(S.weekly_census(c, "week", "census_date", ["facility"], ["payor"]), ["facility", "payor"])


@query(
    "m15_monthly_adc", "month:s facility:s adc:f",
    sql="""SELECT strftime(census_date, '%Y-%m') AS month, facility, avg(x) AS adc FROM (
             SELECT facility, week, any_value(census_date) AS census_date, count(*) / count(DISTINCT census_date) AS x
             FROM (SELECT *, census_date + CAST(7 - dayofweek(census_date) AS INTEGER) AS week, strftime(census_date, '%Y-%m') AS m FROM census) GROUP BY facility, week, m)
           GROUP BY 1, 2""",
    uses=["census"],
)
def m15b(t):
    c = shapes.census(t).withColumns({"week": dates.week_ending_strict(F.col("census_date")), "month": F.date_format("census_date", "yyyy-MM")})
    return S.average_census(S.weekly_census(c, "week", "census_date", ["month", "facility"]), ["month", "facility"])


_PERIOD = "'p' || ((day({}) - 1) // 10)"
_FRAME_SQL = f"""
  WITH c AS (SELECT facility, payor, census_date, census_date + CAST(7 - dayofweek(census_date) AS INTEGER) AS week, {_PERIOD.format("census_date")} AS period FROM census),
  span AS (SELECT 'actual' AS what, * FROM c WHERE period = 'p2' UNION ALL SELECT 'ytd', * FROM c WHERE period BETWEEN 'p1' AND 'p2'),
  dates AS (SELECT what, week, facility, count(DISTINCT census_date) AS dates FROM span GROUP BY ALL),
  cells AS (
    SELECT d.what, d.week, d.facility, p.payor, count(s.payor) / any_value(d.dates) AS adc
    FROM dates d JOIN (SELECT DISTINCT what, facility, payor FROM span) p USING (what, facility) LEFT JOIN span s ON s.what = d.what AND s.week = d.week AND s.facility = d.facility AND s.payor = p.payor
    GROUP BY 1, 2, 3, 4),
  levels AS (
    SELECT what, week, facility, payor, sum(adc) AS adc, ['site and segment', 'site', 'segment', 'total'][1 + grouping(facility, payor)] AS level
    FROM cells GROUP BY GROUPING SETS ((what, week, facility, payor), (what, week, facility), (what, week, payor), (what, week))),
  a AS (SELECT level, facility, payor, avg(adc) FILTER (WHERE what = 'actual') AS actual, avg(adc) FILTER (WHERE what = 'ytd') AS ytd_actual FROM levels GROUP BY ALL),
  b0 AS (SELECT 'F' || (o_custkey % 6) AS facility, 'P' || (o_orderkey % 3) AS payor, {_PERIOD.format("o_orderdate")} AS period, sum(o_totalprice) / 1e6 AS amount FROM orders GROUP BY ALL),
  b1 AS (
    SELECT facility, payor, period, sum(amount) AS amount, ['site and segment', 'site', 'segment', 'total'][1 + grouping(facility, payor)] AS level
    FROM b0 GROUP BY GROUPING SETS ((period, facility, payor), (period, facility), (period, payor), (period))),
  b AS (SELECT level, facility, payor, max(amount) FILTER (WHERE period = 'p2') AS budget, avg(amount) FILTER (WHERE period BETWEEN 'p1' AND 'p2') AS ytd_budget, max(amount) AS peak_budget FROM b1 GROUP BY ALL)
  SELECT coalesce(a.level, b.level) AS level, coalesce(a.facility, b.facility) AS facility, coalesce(a.payor, b.payor) AS payor, actual, ytd_actual, budget, ytd_budget, peak_budget,
         actual - budget AS variance, (actual - budget) / nullif(budget, 0) AS variance_pct, ytd_actual - ytd_budget AS ytd_variance, (ytd_actual - ytd_budget) / nullif(ytd_budget, 0) AS ytd_variance_pct
  FROM a FULL JOIN b ON a.level = b.level AND a.facility IS NOT DISTINCT FROM b.facility AND a.payor IS NOT DISTINCT FROM b.payor"""


@query(
    "m15_census_frame",
    "level:s facility:s payor:s actual:f ytd_actual:f budget:f ytd_budget:f peak_budget:f variance:f variance_pct:f ytd_variance:f ytd_variance_pct:f",
    sql=_FRAME_SQL, uses=["census"],
)
def m15_frame(t):
    """Ten-day periods stand for months: the events span one."""
    period = lambda d: F.concat(F.lit("p"), F.floor((F.dayofmonth(d) - 1) / 10).cast("string"))
    census = shapes.census(t).select("facility", "payor", "census_date", dates.week_ending_strict(F.col("census_date")).alias("week"), period("census_date").alias("period"))
    budget = t.orders.select(
        F.expr("'F' || (o_custkey % 6)").alias("facility"), F.expr("'P' || (o_orderkey % 3)").alias("payor"), period("o_orderdate").alias("period"), (F.col("o_totalprice") / 1e6).alias("amount")
    )
    return S.census_frame(census, budget, week="week", month="period", day="census_date", site="facility", segment="payor", amount="amount", start="p1", cutoff="p2")


@query(
    "m16_budget_context", "entity:s type:s ytd_budget:f peak_budget:f",
    sql="""SELECT entity, type, sum(amount) FILTER (WHERE strftime(month_ending, '%Y-%m') BETWEEN '2000-01' AND '2000-06') / count(*) FILTER (WHERE strftime(month_ending, '%Y-%m') BETWEEN '2000-01' AND '2000-06') AS ytd_budget,
           max(amount) AS peak_budget FROM budget GROUP BY 1, 2""",
    uses=["budget"],
)
def m16(t):
    b = shapes.budget(t).withColumn("month", F.date_format("month_ending", "yyyy-MM"))
    return M.budget_ytd(b, ["entity", "type"], "month", "amount", "2000-01", "2000-06")


@query(
    "m16_variance", "month_ending:s entity:s type:s actual:f budget:f variance:f variance_pct:f",
    sql="""WITH a AS (SELECT month_ending, entity, type, sum(amount) AS actual FROM fin_monthly GROUP BY 1, 2, 3), b AS (SELECT month_ending, entity, type, sum(amount) AS budget FROM budget GROUP BY 1, 2, 3)
           SELECT month_ending, entity, type, actual, budget, actual - budget AS variance, CASE WHEN budget <> 0 THEN (actual - budget) / budget END AS variance_pct FROM a FULL OUTER JOIN b USING (month_ending, entity, type)""",
    uses=["fin_monthly", "budget"],
)
def m16b(t):
    def rows(df, name):
        return df.select("month_ending", "entity", "type", F.lit(name).alias("k"), "amount")

    both = rows(finance.fin_monthly(shapes.bank(t), shapes.historical(t)), "actual").unionByName(rows(shapes.budget(t), "budget"))
    one = both.groupBy("month_ending", "entity", "type").agg(*[F.sum(F.when(F.col("k") == k, F.col("amount"))).alias(k) for k in ("actual", "budget")])
    return M.variance(one, "actual", "budget")


@query(
    "m17_anchors", "latest:s anchor:s report_thursday:s",
    sql="""WITH m AS (SELECT greatest((SELECT max(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) AS latest)
           SELECT latest, latest - CAST((dayofweek(latest) + 3) % 7 AS INTEGER) AS anchor, latest + CAST((4 - dayofweek(latest) + 7) % 7 AS INTEGER) AS report_thursday FROM m""",
)
def m17(t):
    a = M.anchor_date([t.orders.agg(F.max(F.col("o_orderdate").cast("date"))), t.lineitem.agg(F.max(F.col("l_shipdate").cast("date")))])
    return a.withColumn("report_thursday", M.report_thursday(F.col("latest")))


@query(
    "m_target_attainment", "program:s admits_t4w:i monthly_admit_target:i weekly_admit_target:f attainment:f",
    sql="""SELECT program, count(*) AS admits_t4w, 150 AS monthly_admit_target, 37.5 AS weekly_admit_target, count(*) / 150 AS attainment FROM opps
           WHERE stage = 'Admitted' AND created_day > DATE '2000-06-01' AND created_day <= DATE '2000-06-29' GROUP BY 1""",
    uses=["opps"],
)
def m_target(t):
    goals = literal_table(t.spark, [("late", "a", 100), ("late", "b", 50), ("early", "a", 9)], "era string, bucket string, goal int")
    rubric = literal_table(t.spark, [("late", "a", 2.0)], "era string, bucket string, points double")
    tgt = M.era_target(scoring.targets(goals, rubric), "2000-06-29", "1998-04-30", "early", "late")
    o = shapes.opportunities(t).where(F.col("stage") == "Admitted")
    now = M.trailing_at(o, ["program"], "created_day", "2000-06-29", {"admits": F.lit(1)}).where("admits_t is not null")
    month, week = tgt.select("monthly_admit_target").scalar(), tgt.select("weekly_admit_target").scalar()
    return now.select(
        "program", F.col("admits_t").alias("admits_t4w"), month.alias("monthly_admit_target"), week.alias("weekly_admit_target"),
        M.ratio(F.col("admits_t"), month).alias("attainment"),
    )
