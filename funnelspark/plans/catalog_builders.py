"""Queries of the scoring, assembly and finance builders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from funnelspark.functions import dates, rules
from funnelspark.operators import calls as C
from funnelspark.operators import census as S
from funnelspark.operators import dedupe as D
from funnelspark.operators import dims, finance, scoring
from funnelspark.operators import quality as Q
from funnelspark.plans import shapes
from funnelspark.plans.catalog_functions import BRIEF_SQL
from funnelspark.plans.registry import query
from funnelspark.sources.tables import literal_table, normalise_sheet

_RUBRIC = [
    ("Approved - Green", "BUILDING", "early", 3.0, "Gold"), ("Approved - Green", "BUILDING", "late", 4.0, "Gold"),
    ("Approved - Red", "MACHINERY", "early", 1.0, "Iron"), ("approved - yellow", "household", "late", 2.5, "Silver"),
]
_RUBRIC_SQL = "(VALUES " + ", ".join(str(r) for r in _RUBRIC) + ") AS r(payor, loc, era, points, bucket)"


@query(
    "c1_rubric_score",
    "opportunity_id:i points:f bucket:s",
    sql=f"""
      SELECT opportunity_id, CASE WHEN program = 'FURNITURE' THEN 2.0 WHEN program = 'AUTOMOBILE' THEN 1.5 ELSE coalesce(r.points, 0) END AS points,
             CASE WHEN program = 'FURNITURE' THEN 'Flat' WHEN program = 'AUTOMOBILE' THEN 'Flat auto' ELSE coalesce(r.bucket, 'Other') END AS bucket
      FROM (SELECT *, CASE WHEN stage <> 'Pending' AND created_day <= DATE '1998-04-30' THEN 'early' ELSE 'late' END AS e FROM opps) o
      LEFT JOIN {_RUBRIC_SQL} ON lower(o.vob_status) = lower(r.payor) AND lower(o.program) = lower(r.loc) AND o.e = r.era""",
    uses=["opps"],
)
def c1(t):
    o = shapes.opportunities(t).withColumn("dated", F.when(F.col("stage") != "Pending", F.col("created_day")))
    rubric = literal_table(t.spark, _RUBRIC, "payor string, loc string, era string, points double, bucket string")
    flat = [(F.col("program") == "FURNITURE", 2.0, "Flat"), (F.col("program") == "AUTOMOBILE", 1.5, "Flat auto")]
    return scoring.rubric_points(
        o, rubric, payor="vob_status", bucket="program", day="dated", cut="1998-04-30", flat=flat, eras=("early", "late")
    )


_BLOCK_SQL = """
  SELECT *, CASE WHEN nationkey = 0 THEN 'Not in CRM' WHEN stage <> 'Admitted' THEN 'Not Admitted in CRM (' || stage || ')'
    WHEN st IS NULL THEN 'No scorable VOB Status (None)' WHEN program = 'AUTOMOBILE' THEN 'Untracked program (AUTOMOBILE)'
    WHEN st = 'Self Pay' AND lead_type IN ('BD', 'Step Down') THEN 'Self Pay excluded (lead type ' || lead_type || ')'
    WHEN st = 'Self Pay' AND program <> 'BUILDING' THEN 'Self Pay excluded (program)' WHEN st = 'Self Pay' THEN 'Self Pay'
    WHEN lead_type IN ('BD', 'Alumni') THEN lead_type || CASE WHEN inp THEN ' Inpt ' ELSE ' Outpt ' END ||
         CASE WHEN c = 'P' AND NOT inp THEN 'P (not scored)' ELSE c END
    WHEN lead_type = 'Step Down' THEN 'Standard excluded (lead type Step Down)'
    WHEN inp AND c = 'P' THEN CASE WHEN program = 'MACHINERY' THEN 'Standard Inpt P (listed program)' ELSE 'Standard Inpt P (not scored)' END
    WHEN NOT inp AND c = 'P' THEN 'Standard Outpt P (not scored)' ELSE 'Standard ' || CASE WHEN inp THEN 'Inpt ' ELSE 'Outpt ' END || c END AS block
  FROM (SELECT *, program IN ('BUILDING', 'MACHINERY') AS inp, CASE WHEN opportunity_id % 13 <> 0 THEN vob_status END AS st,
               CASE WHEN vob_status IN ('Approved - Green', 'Approved - Yellow') THEN 'G/Y' WHEN vob_status = 'Approved - Red' THEN 'R' ELSE 'P' END AS c,
               CASE WHEN opportunity_id % 7 <> 0 THEN opportunity_id % 15 END AS los FROM opps)"""
# Written out, not taken from the operator's table.
_POINTS_SQL = """CASE WHEN block = 'Standard Inpt G/Y' THEN 10 WHEN block IN ('Standard Inpt R', 'Standard Outpt G/Y', 'BD Inpt G/Y', 'Alumni Inpt G/Y', 'Self Pay') THEN 3
  WHEN block IN ('Standard Inpt P (listed program)', 'BD Outpt G/Y', 'Alumni Outpt G/Y', 'Approved-Orange (flat)') THEN 2
  WHEN block IN ('Standard Outpt R', 'BD Inpt R', 'Alumni Inpt R') THEN 1 WHEN block IN ('BD Inpt P', 'BD Outpt R', 'Alumni Inpt P', 'Alumni Outpt R') THEN 0.5 ELSE 0 END"""


def _blocks(t):
    o = shapes.opportunities(t).withColumns(
        {
            "method": F.when(F.col("nationkey") == 0, F.lit("No match (x)")).otherwise(F.lit("Tier 1")),
            "st": F.when(F.col("opportunity_id") % 13 != 0, F.col("vob_status")),
            "los": F.when(F.col("opportunity_id") % 7 != 0, F.col("opportunity_id") % 15),
        }
    )
    return scoring.score_blocks(
        o, method="method", stage="stage", status="st", program="program", lead_type="lead_type",
        inpatient=["BUILDING", "MACHINERY"], outpatient=["FURNITURE", "HOUSEHOLD"], self_pay_programs=["BUILDING"], purple_programs=["MACHINERY"],
    )


@query(
    "c2_block_score", "block:s n:i points:f",
    sql=f"SELECT block, count(*) AS n, sum({_POINTS_SQL}) AS points FROM ({_BLOCK_SQL}) GROUP BY 1", uses=["opps"],
)
def c2(t):
    return _blocks(t).groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum("points_raw").alias("points"))


_CATEGORY_SQL = "CASE WHEN nationkey IN (1, 2) THEN 'strategic_partner' WHEN lead_type = 'Alumni' THEN 'alumni' WHEN lead_type = 'BD' THEN 'bd' ELSE 'standard' END"
_SCORE3_SQL = f"""
  SELECT *, CASE WHEN c IS NULL THEN 3.0 WHEN category = 'strategic_partner' THEN 2.0 WHEN tier IS NULL THEN 0 ELSE
    CASE WHEN category = 'standard' AND tier = 'inpatient' THEN CASE c WHEN 'GY' THEN 10 WHEN 'R' THEN 3 ELSE 2 END WHEN category = 'standard' THEN CASE c WHEN 'GY' THEN 3 WHEN 'R' THEN 1 ELSE 0 END
         WHEN tier = 'inpatient' THEN CASE c WHEN 'GY' THEN 3 WHEN 'R' THEN 1 ELSE 0.5 END ELSE CASE c WHEN 'GY' THEN 2 WHEN 'R' THEN 0.5 ELSE 0 END END END AS points
  FROM (SELECT *, {_CATEGORY_SQL} AS category, CASE WHEN program IN ('BUILDING', 'MACHINERY') THEN 'inpatient' WHEN program = 'FURNITURE' THEN 'outpatient' END AS tier,
        CASE WHEN vob_status IN ('Approved - Green', 'Approved - Yellow') THEN 'GY' WHEN vob_status = 'Approved - Red' THEN 'R' WHEN vob_status = 'Approved - Purple' THEN 'P' END AS c FROM opps)"""


def _scored(t):
    o = shapes.opportunities(t).withColumn("referral", F.concat(F.lit("House of Nation "), F.col("nationkey").cast("string"), F.lit(" east")))
    return scoring.score_admits(
        o, "program", "vob_status", "lead_type", "referral", ["BUILDING", "MACHINERY"], ["FURNITURE"], ["nation 1 ", "Nation 2 "]
    )


@query(
    "c3_point_table", "category:s tier:s colour:s n:i points:f",
    sql=f"SELECT category, tier, c AS colour, count(*) AS n, sum(points) AS points FROM ({_SCORE3_SQL}) GROUP BY 1, 2, 3", uses=["opps"],
)
def c3(t):
    return _scored(t).groupBy("category", "tier", "colour").agg(F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"))


@query(
    "c4_stay_override", "opportunity_id:i points:f los_override:i override_reason:s",
    sql=f"""SELECT opportunity_id, CASE WHEN p <> 0 AND los < 7 THEN 0 ELSE p END AS points, coalesce(p <> 0 AND los < 7, false) AS los_override,
            CASE WHEN p <> 0 AND los < 7 THEN 'LOS=' || los || 'd < 7d' ELSE '' END AS override_reason FROM (SELECT *, {_POINTS_SQL} AS p FROM ({_BLOCK_SQL}))""",
    uses=["opps"],
)
def c4(t):
    return scoring.stay_override(_blocks(t), "los")


@query(
    "c5_opener_credit", "opener:s block:s n:i points:f",
    sql="""SELECT opener, CASE WHEN lead_type <> 'SEO' THEN 'Excluded VOB (lead type ' || lead_type || ')' WHEN vob_status IN ('Approved - Green', 'Approved - Yellow') THEN 'OON VoBs (Green & Yellow)'
           WHEN vob_status IN ('Approved - Red', 'Approved - Purple') THEN 'INN VoBs (Red & Purple)' ELSE 'Non-scoring VOB' END AS block, count(*) AS n,
           sum(CASE WHEN lead_type <> 'SEO' THEN 0 WHEN vob_status IN ('Approved - Green', 'Approved - Yellow') THEN 1.0 WHEN vob_status IN ('Approved - Red', 'Approved - Purple') THEN 0.5 ELSE 0 END) AS points
           FROM opps GROUP BY 1, 2""",
    uses=["opps"],
)
def c5(t):
    block, points = scoring.opener_credit(F.col("vob_status"), F.col("lead_type"))
    o = shapes.opportunities(t).withColumns({"block": block, "points": points})
    return o.groupBy("opener", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"))


@query(
    "c6_length_of_stay", "casefile_id:s admission_date:s discharge_final:s los_days:i dropped_out:i",
    sql="""
      WITH a AS (SELECT casefile_id, admission_date, max(census_date) AS seen, arg_max(discharge_date, (census_date, event_id)) FILTER (WHERE discharge_date IS NOT NULL) AS dd
                 FROM census_rows GROUP BY 1, 2), m AS (SELECT max(census_date) AS last FROM census_rows)
      SELECT casefile_id, admission_date, CASE WHEN dd IS NULL AND seen < last THEN seen ELSE dd END AS discharge_final,
             (CASE WHEN dd IS NULL AND seen < last THEN seen ELSE dd END) - admission_date AS los_days, dd IS NULL AND seen < last AS dropped_out FROM a, m""",
    uses=["census_rows"],
)
def c6(t):
    rows = shapes.census_rows(t).select("casefile_id", "admission_date", "census_date", "event_id", "discharge_date")
    adm = S.backfill_last(rows, ["casefile_id", "admission_date"], "census_date", ["discharge_date"], "event_id")
    return S.length_of_stay(adm, S.last_day_of(rows, "census_date"), "admission_date", "discharge_date", "census_date")


@query(
    "c7_rule_stack", "category:s n:i points:f",
    sql="""
      SELECT category, count(*) AS n, sum(p) AS points FROM (
        SELECT 'G/Y tier' AS category, 10.0 AS p FROM opps WHERE stage = 'Admitted' AND program IN ('BUILDING', 'MACHINERY') AND vob_status IN ('Approved - Green', 'Approved - Yellow')
        UNION ALL SELECT 'Red', 3.0 FROM opps WHERE stage = 'Admitted' AND vob_status = 'Approved - Red'
        UNION ALL SELECT 'Rep required', 0.5 FROM opps WHERE stage = 'Admitted' AND lead_type IN ('BD', 'SEO') AND closer <> 'rep-0'
        UNION ALL SELECT 'Contains', 2.0 FROM opps WHERE stage = 'Admitted' AND contains(lead_type, 'Step')) GROUP BY 1""",
    uses=["opps"],
)
def c7(t):
    o = shapes.opportunities(t).where(F.col("stage") == "Admitted").withColumn("rep", F.expr("nullif(closer, 'rep-0')"))
    r = scoring.program_rule
    rules = [
        ("G/Y tier", r(programs=("program", ["BUILDING", "MACHINERY"]), status=("vob_status", ["Approved - Green", "Approved - Yellow"])), 10.0),
        ("Red", r(status=("vob_status", ["Approved - Red"])), 3.0),
        ("Rep required", r(level=("lead_type", ["BD", "SEO"]), filled="rep"), 0.5),
        ("Contains", r(contains=("lead_type", "Step")), 2.0),
    ]
    return scoring.apply_rules(o, rules).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"))


@query(
    "c8_event_table", "event_id:s event_type:s event_date:s rep:s category:s points:f",
    sql=f"""
      WITH s AS ({_SCORE3_SQL})
      SELECT sha256('admit|' || opportunity_id) AS event_id, 'admit' AS event_type, created_day AS event_date, closer AS rep, category, points FROM s
      WHERE stage = 'Admitted' AND created_day BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' AND closer IN ('rep-1', 'rep-2', 'rep-3')
      UNION ALL SELECT sha256('vob|' || opportunity_id), 'vob', created_day, closer, 'vob', CASE c WHEN 'GY' THEN 1.0 ELSE 0.5 END FROM s
      WHERE c IS NOT NULL AND created_day BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' AND closer IN ('rep-1', 'rep-2', 'rep-3')""",
    uses=["opps"],
)
def c8(t):
    w = dates.Window(date(1997, 1, 1), date(1998, 12, 31))
    s = _scored(t).where(w.holds(F.col("created_day")) & F.col("closer").isin("rep-1", "rep-2", "rep-3"))

    def event(kind, category, points):
        return s.select(
            scoring.event_id(F.lit(kind), F.col("opportunity_id")).alias("event_id"), F.lit(kind).alias("event_type"),
            F.col("created_day").alias("event_date"), F.col("closer").alias("rep"), category.alias("category"), points.alias("points"), "stage",
        )

    admits = event("admit", F.col("category"), F.col("points")).where(F.col("stage") == "Admitted")
    vobs = event("vob", F.lit("vob"), scoring.score_vob(F.col("vob_status"))).where(F.col("points") > 0)
    return admits.unionByName(vobs)


@query(
    "c9_targets", "era:s bucket:s admit_target:i point_unit:f point_target:f",
    sql=f"""
      WITH g AS (SELECT CASE WHEN created_day <= DATE '1998-04-30' THEN 'early' ELSE 'late' END AS era, CASE WHEN program = 'BUILDING' THEN 'Gold' WHEN program = 'MACHINERY' THEN 'Iron' WHEN program = 'FURNITURE' THEN 'Flat' ELSE 'Total' END AS bucket,
                 count(*) // 10 AS goal FROM opps GROUP BY 1, 2),
      u AS (SELECT era, bucket, max(points) AS unit FROM {_RUBRIC_SQL} GROUP BY 1, 2)
      SELECT g.era, g.bucket, goal AS admit_target, CASE WHEN g.bucket = 'Flat' THEN 2.0 ELSE coalesce(unit, 0) END AS point_unit,
             round(goal * CASE WHEN g.bucket = 'Flat' THEN 2.0 ELSE coalesce(unit, 0) END, 2) AS point_target FROM g LEFT JOIN u USING (era, bucket) WHERE g.bucket <> 'Total'""",
    uses=["opps"],
)
def c9(t):
    goals = shapes.opportunities(t).groupBy(
        F.expr("CASE WHEN created_day <= DATE '1998-04-30' THEN 'early' ELSE 'late' END").alias("era"),
        F.expr("CASE program WHEN 'BUILDING' THEN 'Gold' WHEN 'MACHINERY' THEN 'Iron' WHEN 'FURNITURE' THEN 'Flat' ELSE 'Total' END").alias("bucket"),
    ).agg(F.floor(F.count(F.lit(1)) / 10).alias("goal"))
    rubric = literal_table(t.spark, _RUBRIC, "payor string, loc string, era string, points double, bucket string")
    return scoring.targets(goals, rubric, {"Flat": 2.0})


_SHEET = {
    "mr_number": {"is": ["MR", "MR Number"]}, "admit_date": {"is": ["Admission Date"], "type": "date"},
    "patient_name": {"any": ["full name", "name"], "exclude": ["company"]}, "points": {"any": ["points"], "type": "double"},
    "facility": {"is": ["Facility"], "default": "Default"}, "bucket": {"any": ["bucket"]},
}


@query(
    "c10_verified_admits", "mr_number:s admit_date:s patient_name:s points:f facility:s source_type:s dup_flag:i dup_sources:s",
    sql="""
      WITH u AS (
        SELECT CAST(o_custkey AS VARCHAR) AS mr_number, CAST(o_orderdate AS DATE) AS admit_date, 'Order ' || o_orderkey AS patient_name, o_totalprice AS points, o_orderstatus AS facility, 'weekly' AS source_type, 'orders' AS f FROM orders
        UNION ALL SELECT CAST(o_custkey AS VARCHAR), CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END, NULL, 0, 'Default', 'historical', 'archive' FROM orders WHERE o_orderpriority = '1-URGENT'),
      g AS (SELECT mr_number, admit_date, count(*) AS n, string_agg(DISTINCT f, ' | ' ORDER BY f) AS s FROM u GROUP BY 1, 2)
      SELECT u.*, n > 1 AS dup_flag, CASE WHEN n > 1 THEN s END AS dup_sources FROM u JOIN g ON u.mr_number = g.mr_number AND u.admit_date IS NOT DISTINCT FROM g.admit_date""",
)
def c10(t):
    weekly = t.orders.select(
        F.col("o_custkey").alias(" MR "), F.col("o_orderdate").cast("date").alias("Admission  Date"), F.lit("x").alias("Company Name"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Full Name"), F.col("o_totalprice").alias("Points"),
        F.col("o_orderstatus").alias("facility"),
    )
    old = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("mr number"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string")).otherwise(F.lit("--")).alias("ADMISSION DATE"),
        F.lit("n/a").alias("points"),
    )
    sheets = [
        normalise_sheet(weekly, _SHEET, source_file="orders", source_type="weekly", required=["mr_number", "admit_date"]),
        normalise_sheet(old, _SHEET, source_file="archive", source_type="historical", required=["mr_number", "admit_date"]),
    ]
    return D.flag_duplicates(D.union_all(*sheets), ["mr_number", "admit_date"], "source_file")


@query("c11_fin_monthly", "month_ending:s entity:s type:s amount:f source:s", sql="SELECT * FROM fin_monthly", uses=["fin_monthly"])
def c11(t):
    return finance.fin_monthly(shapes.bank(t), shapes.historical(t))


_UNIFIED_SQL = """
  WITH m AS (SELECT month_ending, entity, coalesce(sum(amount) FILTER (WHERE type = 'Revenue'), 0) AS r, coalesce(sum(amount) FILTER (WHERE type = 'Salaries and Wages'), 0) AS w,
             coalesce(sum(amount) FILTER (WHERE type = 'Other Expenses'), 0) AS o FROM fin_monthly GROUP BY 1, 2)
  SELECT month_ending, entity, 'Actual' AS scenario, 'Revenue' AS type, r AS amount FROM m UNION ALL SELECT month_ending, entity, 'Actual', 'S&W', w FROM m
  UNION ALL SELECT month_ending, entity, 'Actual', 'EBITDA', r - w - o FROM m
  UNION ALL SELECT month_ending, entity, 'Budget', CASE WHEN type = 'Salaries and Wages' THEN 'S&W' ELSE type END, amount FROM budget"""


@query("c12_fin_unified", "month_ending:s entity:s scenario:s type:s amount:f", sql=_UNIFIED_SQL, uses=["fin_monthly", "budget"])
def c12(t):
    return finance.fin_unified(finance.fin_monthly(shapes.bank(t), shapes.historical(t)), shapes.budget(t))


@query(
    "c13_weekly_targets", "month_ending:s entity:s type:s weeks:i target:f",
    sql="""WITH w AS (SELECT last_day(CAST(d AS DATE)) AS month_ending, count(*) AS n FROM generate_series(DATE '1995-01-01', DATE '2001-12-30', INTERVAL 7 DAY) AS g(d) GROUP BY 1)
           SELECT month_ending, entity, type, n AS weeks, amount AS target FROM budget JOIN w USING (month_ending)""",
    uses=["budget"],
)
def c13(t):
    w = finance.weekly_targets(shapes.budget(t), "1995-01-01", "2001-12-30")
    return w.groupBy("month_ending", "entity", "type").agg(F.count(F.lit(1)).alias("weeks"), F.sum("weekly_target").alias("target"))


@query(
    "c14_dimensions", "date_key:s year_month:s week_ending:s is_weekend:i orders:i",
    sql="""SELECT CAST(d AS DATE) AS date_key, strftime(d, '%Y-%m') AS year_month, CAST(d AS DATE) + CAST((4 - dayofweek(d) + 7) % 7 AS INTEGER) AS week_ending,
           dayofweek(d) IN (0, 6) AS is_weekend, count(o_orderkey) AS orders FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) AS g(d)
           LEFT JOIN orders ON o_orderdate = d GROUP BY ALL""",
)
def c14(t):
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))
    return dims.dim_date(t.spark, "1995-01-01", "2001-12-31").join(daily, "date_key", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(
    "c15_date_coverage", "user_id:i day:s events:i status:s",
    sql="""
      WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1, 2),
      s AS (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY 1)
      SELECT s.user_id, s.day, coalesce(events, 0) AS events, CASE WHEN coalesce(events, 0) = 0 THEN 'zero' WHEN events < 2 THEN 'low' ELSE 'ok' END AS status
      FROM s LEFT JOIN d USING (user_id, day)""",
)
def c15(t):
    return Q.date_coverage(t.events.select("user_id", F.col("ts").cast("date").alias("day")), ["user_id"], "day", low=2)


@query(
    "c16_commentary", "commentary:s",
    sql=f"""
      WITH g AS (SELECT agent_id, count(*) FILTER (WHERE call_date BETWEEN DATE '2024-01-23' AND DATE '2024-01-29') AS a, count(*) FILTER (WHERE call_date BETWEEN DATE '2024-01-16' AND DATE '2024-01-22') AS b
                 FROM (SELECT *, {BRIEF_SQL} AS channel FROM calls) WHERE channel = 'PPC' GROUP BY 1),
      d AS (SELECT *, CAST(round(100.0 * ((a - b) / b)) AS INTEGER) AS p, row_number() OVER (ORDER BY a - b, agent_id) AS rn FROM g WHERE b > 0 AND a / b - 1 < -0.15)
      SELECT CASE WHEN count(*) > 0 THEN count(*) || CASE WHEN count(*) = 1 THEN ' rep' ELSE ' reps' END || ' down sharply week over week - ' ||
             string_agg(agent_id || ' ' || CASE WHEN p >= 0 THEN '+' ELSE '' END || p || '%', ' . ' ORDER BY rn) FILTER (WHERE rn <= 3) END AS commentary FROM d""",
    uses=["calls"],
)
def c16(t):
    paid = shapes.calls(t).where(rules.brief_channel(F.col("source")) == "PPC")
    wow = C.week_over_week(paid, "agent_id", date(2024, 1, 29))
    return C.commentary(wow, "agent_id", [F.col("last7") - F.col("prior7"), F.col("agent_id")], "rep", "reps")


@query(
    "c17_status_row", "unmapped_program:i unmapped_payor:i total_rows:i data_status:s",
    sql="""SELECT count(*) FILTER (WHERE program = 'error') AS unmapped_program, count(*) FILTER (WHERE payor = 'P9') AS unmapped_payor, count(*) AS total_rows,
           CASE WHEN count(*) FILTER (WHERE program = 'error') > 0 THEN 'ISSUES FOUND' ELSE 'ALL CLEAN' END AS data_status FROM census""",
    uses=["census"],
)
def c17(t):
    return Q.status_row(shapes.census(t), {"unmapped_program": F.col("program") == "error", "unmapped_payor": F.col("payor") == "P9"})


@query(
    "c18_weekly_fact", "opportunity_id:i c_name:s block:s points:f week_label:s week_end:s",
    sql=f"""SELECT opportunity_id, 'Client ' || c_name AS c_name, block, {_POINTS_SQL} AS points, '1998-05-22_to_1998-05-28' AS week_label, DATE '1998-05-28' AS week_end
            FROM ({_BLOCK_SQL}) JOIN customer ON client_id = c_custkey WHERE created_day BETWEEN DATE '1998-05-22' AND DATE '1998-05-28'""",
    uses=["opps"],
)
def c18(t):
    w = dates.last_full_week(date(1998, 6, 1))
    return _blocks(t).where(w.holds(F.col("created_day"))).select(
        "opportunity_id", F.col("client_name").alias("c_name"), "block", F.col("points_raw").alias("points"),
        F.lit(w.label).alias("week_label"), F.lit(w.end).alias("week_end"),
    )
