"""End-to-end jobs on invented fixtures."""

import json
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from funnelspark.functions.dates import Window
from funnelspark.plans import jobs
from funnelspark.sources.json_pages import read_roots

T0 = int(datetime(2024, 3, 5, 18, 0, tzinfo=timezone.utc).timestamp())


def call(i, **kw):
    base = dict(id=i, account_id=1, unix_time=T0 + i, direction="inbound", status="answered", talk_time=60, ring_time=3, caller_number="5550000001",
                caller_number_bare="5550000001", source="Main", agent_id="a1", agent={"name": "Uma  Vex", "email": "u@x"}, tracking_label="x")
    return {**base, **kw}


def blobs(spark, tmp_path):
    old = [call(1, status="Busy ", talk_time=None), call(2, status="busy", talk_time=None)]
    new = [
        call(1, status="busy", talk_time=None), call(3, direction="outbound", unix_time=T0 + 1000, agent_id="a2", agent={"name": "uma vex", "email": None}, source=None, tracking_label="north outbound"),
        call(4, direction="form", status="received", caller_number="5550000009", caller_number_bare="5550000009", source=" "), call(5), call(6),
        call(7, unix_time=int(datetime(2024, 3, 6, 4, 0, tzinfo=timezone.utc).timestamp())),
    ]
    for root, at, rows in (("rebuild", "2024-03-05", old), ("live", "2024-03-06", new)):
        (tmp_path / root).mkdir()
        (tmp_path / root / "d.json").write_text(json.dumps({"account_slug": "acc", "ingested_at": at, "calls": rows}))
    df, skipped = read_roots(spark, {"rebuild": f"{tmp_path}/rebuild", "live": f"{tmp_path}/live"}, jobs.CALL_SCHEMA)
    assert not skipped
    return df


def events(spark, tmp_path):
    site_map = spark.createDataFrame([(1, "Main", "S1"), (1, "", "Out")], "account_id int, source_name string, site string")
    return jobs.call_events(blobs(spark, tmp_path), zone="America/Chicago", as_of_unix=T0 + 10 * 86400, site_map=site_map,
                            label_sites=[(["NORTH"], "North")], outbound_site="Out")


def test_call_events(spark, tmp_path):
    got = {r.id: r for r in events(spark, tmp_path).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7]
    assert got[1].ingested_at == "2024-03-06" and got[1].outcome == "missed"
    assert got[1].callback_call_id == 3 and got[1].callback_minutes == 16 and got[1].callback_by_same_agent is True
    assert {r.agent_id for r in got.values()} == {"a1"}
    assert (got[3].site, got[3].site_resolved, got[5].site_resolved) == ("Out", "North", "S1")
    assert got[7].call_date == date(2024, 3, 5)


def test_publish_calls_twice(spark, tmp_path):
    prefix = "p" + uuid.uuid4().hex[:8]
    calls = events(spark, tmp_path)
    first = jobs.publish_calls(calls, prefix)
    n = first["daily_site_stats"].count()
    again = jobs.publish_calls(calls, prefix)
    assert again["daily_site_stats"].count() == n and spark.table(f"{prefix}_calls").count() == 7
    assert spark.table(f"{prefix}_form").count() == 1


def opportunities(spark):
    rows = [
        ("o1", "(555) 000-0001", datetime(2024, 3, 6), "Approved - Green", "Admits", "Admitted", "m1", "Uma", "Vex", date(1990, 1, 1)),
        ("o2", "5550000001", datetime(2024, 3, 5, 18, 0, 0), "pending", None, "Open", None, "Uma", "Vex", None),
        ("o3", None, datetime(2024, 3, 6), None, None, None, None, "Noa", "Ray", date(1991, 1, 1)),
    ]
    schema = ("opportunity_id string, phone string, created_at timestamp, vob_status string, viable string, stage string, mr_number string, "
              "client_first_name string, client_last_name string, dob date")
    return spark.createDataFrame(rows, schema).withColumns({"opener": F.lit("op"), "closer": F.lit(None).cast("string"), "lead_source": F.lit("web")})


def test_opportunity_facts(spark, tmp_path):
    opps = opportunities(spark)
    facts, calls = jobs.opportunity_facts(opps, events(spark, tmp_path))
    got = {r.opportunity_id: r for r in facts.collect()}
    assert len(got) == 3
    assert (got["o1"].first_call_id, got["o1"].has_vob, got["o1"].is_viable, got["o1"].is_admit) == (1, True, True, True)
    assert (got["o2"].first_call_id, got["o2"].has_vob) == (None, False) and got["o2"].cohort_date == date(2024, 3, 5)
    assert {r.id: r.matched_opportunity_id for r in calls.collect()}[1] == "o1"


def test_admission_facts(spark):
    rows = [
        ("c1", "M1 ", date(2024, 3, 7), date(2024, 3, 7), "X", "Y", None), ("c1", "M1 ", date(2024, 3, 7), date(2024, 3, 8), "X", "Y", None),
        ("c2", "z", date(2024, 3, 7), date(2024, 3, 7), "Noa", "Ray", date(1991, 1, 1)), ("c3", "y", date(2024, 3, 1), date(2024, 3, 1), "uma", " vex", None),
        ("c4", "x", date(2024, 3, 1), date(2024, 3, 1), "No", "One", None),
    ]
    cen = spark.createDataFrame(rows, "casefile_id string, mr_number string, admission_date date, census_date date, first_name string, last_name string, dob date")
    got = {r.casefile_id: (r.opportunity_id, r.match_method) for r in jobs.admission_facts(cen, opportunities(spark)).collect()}
    assert got == {"c1": ("o1", "mr_exact"), "c2": ("o3", "name_dob"), "c3": ("o2", "name_only_proximity"), "c4": (None, "unmatched")}


def test_weekly_funnel_and_history(spark, tmp_path):
    schema = "day date, location string, lead_type string, opener string, closer string, has_vob boolean, is_viable boolean"
    opps = spark.createDataFrame([(date(2024, 3, 5), "L", "BD", None, "c", True, None), (date(2024, 3, 8), "L", "BD", None, "c", False, True)], schema)
    leads, admits = opps.drop("has_vob", "is_viable"), opps.limit(1).drop("has_vob", "is_viable")
    w = Window(date(2024, 3, 7), date(2024, 3, 14))
    weekly = jobs.weekly_funnel(leads, opps, admits, w)
    assert sorted(tuple(r) for r in weekly.collect()) == [
        (date(2024, 3, 7), "L", "BD", "Unknown", "c", 1, 1, 1, 0, 1), (date(2024, 3, 14), "L", "BD", "Unknown", "c", 1, 1, 0, 1, 0),
    ]
    table = "h" + uuid.uuid4().hex[:8]
    for _ in range(2):
        jobs.keep_funnel_history(weekly, table, date(2024, 1, 1), path=f"{tmp_path}/h")
    assert spark.table(table).count() == 2
    month = jobs.weekly_funnel(leads, opps, admits, Window(date(2024, 3, 1), date(2024, 3, 1)), "month_start")
    assert [tuple(r)[5:] for r in month.collect()] == [(2, 2, 1, 1, 1)]


def test_clean_census(spark):
    rows = [
        ("c1", date(2024, 3, 3), "F", "t1", "Ann", "Lee", "m1", " Detox", "L", "Aetna", "Left – early", None),
        ("c1", date(2024, 3, 3), "F", "t2", "Ann", "Lee", "m1", "Detox", "L", "Nope", "Left – early", date(2024, 3, 3)),
        ("c2", date(2024, 3, 4), "F", "t1", "Tester", "Lee", "m2", "Detox", "L", None, None, None),
        ("c3", date(2024, 3, 4), "F", "t1", "Test", "Lee", "m3", None, None, "  ", "odd", None),
    ]
    raw = spark.createDataFrame(rows, "casefile_id string, census_date date, facility string, extraction_timestamp string, first_name string, last_name string, "
                                      "mr_number string, program string, location_name string, insurance_company string, discharge_type string, discharge_date date")
    programs = spark.createDataFrame([("Detox", "F", "L", "Inpatient"), ("NULL", "", "", "None")], "program string, facility string, location string, grp string")
    payors = spark.createDataFrame([("Aetna", "Commercial")], "key string, grp string")
    discharges = spark.createDataFrame([("Left - early", "AMA")], "key string, grp string")
    clean = jobs.clean_census(raw, programs=programs, payors=payors, discharges=discharges, allow=["c3"],
                              budget_rules=[({"program_group": "Inpatient", "payor_group": "!VA"}, "Beds")])
    got = {r.casefile_id: (r.program_group, r.payor_group, r.discharge_group, r.week_ending, r.budget_category) for r in clean.collect()}
    assert got == {"c1": ("Inpatient", "UNMAPPED", "AMA", date(2024, 3, 10), "Beds"), "c3": ("None", "Other", None, date(2024, 3, 10), "Unbudgeted")}
    assert jobs.census_status(clean).first().data_status == "ISSUES FOUND"


def test_attribution_to_events(spark, tmp_path):
    admits = spark.createDataFrame(
        [("m1", "Ann", "Lee", "North House", date(2024, 3, 5)), ("m2", "Bo", "Marsh", "North House", date(2024, 3, 6)), ("m3", "Cy", "Q", "Elsewhere", date(2024, 3, 6)),
         ("m4", "Dana", "Winterfeld", "North House", date(2024, 3, 7))],
        "mr_number string, first_name string, last_name string, location_name string, admission_date date")
    opps = spark.createDataFrame(
        [("o1", "m1", "north", "x-1", "Open", "Approved - Red", "BD", None, "rep1", datetime(2024, 1, 1)), ("o2", "m1", "north", "x-2", "Admitted", "Approved - Green", "BD", None, "rep1", None),
         ("o3", "zz", "North ", "Bo Marsh-17", "Admitted", "Self Pay", "SEO", None, "rep2", None), ("o4", None, "north", "Dana Winterfeldt", "Admitted", "Approved - Red", "SEO", "Great Partner", "rep1", None)],
        "opportunity_id string, mr_number string, treatment_program string, account_name string, sales_stage string, vob_status string, lead_type string, referral_source string, closer string, modified_at timestamp",
    ).withColumn("opener", F.lit("op"))
    att = jobs.attribute_admits(admits, opps, {"north house": "north"})
    got = {r.mr_number: (r.opportunity_id, r.match_method, r.match_confidence) for r in att.collect()}
    assert got == {"m1": ("o2", "id + block", 100), "m2": ("o3", "name + block", 95), "m3": (None, "no match (unmapped block)", 0), "m4": ("o4", "name fuzzy", 96)}
    ev = jobs.admit_events(att, ["rep1", "rep2"], ["North House"], [], ["great"])
    assert {r.mr_number: (r.category, r.points) for r in ev.collect()} == {"m1": ("bd", 3.0), "m2": ("standard", 3.0), "m4": ("strategic_partner", 2.0)}
    table = "e" + uuid.uuid4().hex[:8]
    for _ in range(2):
        jobs.keep_events(ev, table, Window(date(2024, 3, 1), date(2024, 3, 31)), f"{tmp_path}/e")
    assert spark.table(table).count() == 3
