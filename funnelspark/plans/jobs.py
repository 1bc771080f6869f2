"""End-to-end jobs: call events, CRM funnel, census, weekly attribution.

Each step is a function from frames to frames, so a job can stop, be tested or be written at any of them. Facts
that several outputs read are expected to be written as tables between the steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import dates, rules, text
from funnelspark.operators import calls as C
from funnelspark.operators import census as S
from funnelspark.operators import dedupe as D
from funnelspark.operators import mapping as M
from funnelspark.operators import quality as Q
from funnelspark.operators import scoring as P
from funnelspark.operators.funnel import cohort_date, funnel, stage_flags
from funnelspark.operators.intervals import first_in_window, reverse_link
from funnelspark.operators.linking import Tier, block_match, tiered_link
from funnelspark.session import materialise
from funnelspark.sinks import tables as W

# ---- call events ---------------------------------------------------------------------------

CALL_FIELDS = ("id", "unix_time", "direction", "status", "caller_number", "source", "account_id")
CALL_SCHEMA = (
    "account_slug string, call_date string, call_count int, ingested_at string, calls array<struct<id:bigint,sid:string,account_id:int,"
    "unix_time:bigint,direction:string,status:string,call_status:string,dial_status:string,duration:int,talk_time:int,ring_time:int,"
    "hold_time:int,wait_time:int,caller_number:string,caller_number_bare:string,tracking_number:string,tracking_label:string,"
    "business_number:string,source:string,source_id:int,source_sid:string,agent_id:string,agent:struct<name:string,email:string>,"
    "city:string,state:string,postal_code:string,is_new_caller:boolean,tag_list:array<string>,audio:string,transcription:string,"
    "transcription_text:string,summary:string>>"
)
_LOWER = ("status", "call_status", "dial_status")
_DROPPED = ("agent", "audio", "transcription")


def flatten_calls(blobs: DataFrame, zone: str) -> DataFrame:
    """Blob rows to one row per call: typed columns, local call date, the blob's ingestion time."""
    rows = blobs.select("account_slug", "ingested_at", F.explode("calls").alias("call"))
    Q.assert_schema(rows, CALL_FIELDS, struct="call")
    names = [f for f in rows.schema["call"].dataType.fieldNames() if f not in _DROPPED]

    def field(n: str) -> Column:
        c = F.col(f"call.{n}")
        if n in _LOWER:
            c = F.lower(F.trim(c))
        return (F.trim(c) if n == "source" else c).alias(n)

    return rows.select(
        "account_slug", "ingested_at", *[field(n) for n in names], F.col("call.agent.name").alias("agent_name"),
        F.col("call.agent.email").alias("agent_email"), F.col("call.audio").alias("audio_url"), F.col("call.transcription").alias("transcription_url"),
        F.timestamp_seconds("call.unix_time").alias("called_at"), dates.local_date(F.col("call.unix_time"), zone).alias("call_date"),
    )


def one_identity(calls: DataFrame, aliases: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(calls with one agent id per person, crosswalk): the id with most calls of a normalised name wins."""
    named = calls.where(F.col("agent_id").isNotNull()).withColumn("_name", text.person_name(F.col("agent_name"), aliases))
    named = named.where(F.col("_name") != "")
    counts = named.groupBy("_name", "agent_id", "agent_name", "agent_email").agg(F.count(F.lit(1)).alias("n"))
    canon = D.best(counts, ["_name"], [F.col("n").desc(), F.col("agent_id").asc(), F.col("agent_name").asc_nulls_last(), F.col("agent_email").asc_nulls_last()])
    canon = canon.select(
        "_name", F.col("agent_id").alias("canonical_agent_id"), F.col("agent_name").alias("canonical_agent_name"), F.col("agent_email").alias("canonical_agent_email")
    )
    per_id = D.best(counts, ["agent_id"], [F.col("n").desc(), F.col("_name").asc(), F.col("agent_name").asc_nulls_last(), F.col("agent_email").asc_nulls_last()])
    xwalk = per_id.select("agent_id", "_name").join(canon, "_name").drop("_name")
    out = calls.join(xwalk.withColumnRenamed("agent_id", "_id"), F.col("agent_id") == F.col("_id"), "left")
    out = out.withColumns({c: F.coalesce(f"canonical_{c}", c) for c in ("agent_id", "agent_name", "agent_email")})
    return out.select(*calls.columns), xwalk


def call_events(
    blobs: DataFrame, *, zone: str, as_of_unix: int, site_map: DataFrame, label_sites: Sequence[tuple[Sequence[str], str]],
    outbound_site: str, aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Deduplicated, identified, classified calls with their site and first callback.

    ``site_map`` holds (account_id, source_name, site). Calls of the ``outbound_site`` line are attributed by
    the site named in their tracking label where there is one.

    The steps after parsing read their input several times (names are counted and then joined back, callbacks
    look at missed and outbound calls), so the parsed rows and the classified rows are written once each to the
    shared folder: two columnar writes instead of a dozen passes over JSON.
    """
    flat = D.latest(flatten_calls(blobs, zone), ["id"], ["ingested_at", "unix_time"], ["account_slug"])
    people, _ = one_identity(materialise(flat, "calls-flat"), aliases)
    mapped = M.map_pair(C.classify_calls(people), site_map, ("account_id", "source"), ("account_id", "source_name"), "site", "site")
    resolved = F.when(F.col("site") == outbound_site, rules.label_site(F.col("tracking_label"), label_sites, outbound_site)).otherwise(F.col("site"))
    return C.add_callbacks(materialise(mapped.withColumn("site_resolved", resolved), "calls-classified"), as_of_unix)


def call_tables(calls: DataFrame, seen_unmapped: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables derived from call events."""
    return {
        "daily_site_stats": C.daily_stats(calls, ["call_date", "site_resolved", "account_slug"]),
        "daily_agent_stats": C.agent_stats(calls, labels=["agent_name", "agent_email"]),
        "unmapped_log": M.unmapped_audit(calls, F.col("site").isNull(), ["account_id", "account_slug", "source"], "call_date", "tracking_label", seen_unmapped),
        "date_coverage": Q.date_coverage(calls, ["account_slug"], "call_date"),
    }


def publish_calls(calls: DataFrame, prefix: str) -> dict[str, DataFrame]:
    """Write the call events partitioned by day, then every derived table from the written one."""
    spark = calls.sparkSession
    W.overwrite(calls, f"{prefix}_calls", ["call_date"])
    written = spark.table(f"{prefix}_calls")
    log = f"{prefix}_unmapped_log"
    seen = spark.table(log) if spark.catalog.tableExists(log) else None
    out = call_tables(written, seen)
    for name, df in out.items():
        target = f"{prefix}_{name}"
        (W.swap if spark.catalog.tableExists(target) else W.overwrite)(df, target)
    W.typed_views(written, "event_type", {f"{prefix}_voice": "voice", f"{prefix}_text": "sms", f"{prefix}_form": "form_fill", f"{prefix}_chat": "chat"})
    return {n: spark.table(f"{prefix}_{n}") for n in out}


# ---- CRM funnel ----------------------------------------------------------------------------


def opportunity_facts(opps: DataFrame, calls: DataFrame, lookback_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(opportunities with their first inbound call, calls with their opportunity).

    ``opps`` needs opportunity_id, phone, created_at, vob_status, viable and stage.
    """
    inbound = calls.where((F.col("event_type") == "voice") & (F.col("direction") == "inbound")).select(
        F.col("id").alias("call_id"),
        F.coalesce(text.phone_e164(F.col("caller_number_bare")), text.phone_e164(F.col("caller_number"))).alias("caller_phone"),
        F.col("unix_time").alias("call_unix"), "call_date", F.col("source").alias("call_source"), "agent_name", F.col("site_resolved").alias("call_site"),
        F.col("outcome").alias("call_outcome"),
    )
    linked = first_in_window(
        opps.withColumn("_phone", text.phone_e164(F.col("phone"))), inbound, base_key="_phone", base_time=F.unix_timestamp("created_at"),
        event_key="caller_phone", event_time=F.col("call_unix"), event_id="call_id",
        carry=["call_date", "call_source", "agent_name", "call_site", "call_outcome"], after=-lookback_days * C.DAY, until=0, include_start=True, match="_first",
    )
    names = {"id": "first_call_id", "call_date": "first_call_date", "call_source": "first_call_source", "agent_name": "first_call_agent",
             "call_site": "first_call_site", "call_outcome": "first_call_outcome"}
    facts = linked.select(
        *opps.columns, F.col("_phone").alias("phone_e164"), *[F.col(f"_first.{k}").alias(v) for k, v in names.items()],
        *[c.alias(n) for n, c in stage_flags(F.col("vob_status"), F.col("viable"), F.col("stage")).items()],
    ).withColumn("cohort_date", cohort_date(F.col("first_call_date"), F.col("created_at")))
    return facts, reverse_link(calls, facts, "id", "first_call_id", "opportunity_id")


def admission_facts(census: DataFrame, opps: DataFrame) -> DataFrame:
    """One row per admission with its opportunity: id, then name and birth date, then name, nearest in time."""
    adm = D.earliest(
        census.where(F.col("mr_number").isNotNull() & F.col("admission_date").isNotNull()), ["mr_number", "admission_date"], ["census_date"], ["casefile_id"]
    ).withColumns(
        {
            "_id": text.id_key(F.col("mr_number")), "_nb": text.name_birth_key(F.col("first_name"), F.col("last_name"), F.col("dob")),
            "_n": text.name_key(F.col("first_name"), F.col("last_name")),
        }
    )
    cand = opps.select(
        "opportunity_id", "opener", "closer", "lead_source", F.col("created_at").cast("date").alias("_day"), text.id_key(F.col("mr_number")).alias("_oid"),
        text.name_birth_key(F.col("client_first_name"), F.col("client_last_name"), F.col("dob")).alias("_onb"),
        text.name_key(F.col("client_first_name"), F.col("client_last_name")).alias("_on"),
    )
    tiers = [Tier("mr_exact", "_id", "_oid", "high"), Tier("name_dob", "_nb", "_onb", "high"), Tier("name_only_proximity", "_n", "_on", "low")]
    out = tiered_link(
        adm, cand, tiers, base_day=F.col("admission_date"), cand_day=F.col("_day"), rank=[F.col("opportunity_id")],
        carry=["opportunity_id", "opener", "closer", "lead_source"],
    )
    return out.drop("_id", "_nb", "_n").withColumn("is_back_linked", F.col("opportunity_id").isNotNull())


FUNNEL_KEYS = ("location", "lead_type", "opener", "closer")


def weekly_funnel(leads: DataFrame, opps: DataFrame, admits: DataFrame, window: dates.Window, period: str = "week_ending") -> DataFrame:
    """Leads, opportunities, verifications, viable ones and admissions per week (or month) and key.

    Every frame brings ``day`` and the funnel keys. ``period`` is ``week_ending`` (Thursday) or ``month_start``.
    """
    when = dates.week_ending if period == "week_ending" else dates.month_start

    def cut(df: DataFrame) -> DataFrame:
        keyed = df.withColumns(
            {period: when(F.col("day")), "opener": F.coalesce("opener", F.lit("Unknown")), "closer": F.coalesce("closer", F.lit("Unknown"))}
        )
        return keyed.where(window.holds(F.col(period)))

    yes, o = F.lit(True), cut(opps)
    return funnel(
        {"leads": (cut(leads), yes), "opportunities": (o, yes), "vobs": (o, F.col("has_vob")), "viable_vobs": (o, F.col("is_viable")), "admits": (cut(admits), yes)},
        [period, *FUNNEL_KEYS],
    )


def keep_funnel_history(weekly: DataFrame, table: str, floor: date, replace_window: bool = True, path: str | None = None) -> None:
    """Merge the recomputed weeks into the permanent history; weeks outside stay as they are."""
    W.merge(weekly, table, ["week_ending", *FUNNEL_KEYS], "week_ending", floor, replace_window, path)


# ---- census --------------------------------------------------------------------------------


def clean_census(
    raw: DataFrame, *, programs: DataFrame, payors: DataFrame, discharges: DataFrame, allow: Sequence[str] = (),
    budget_rules: Sequence[tuple[Mapping[str, object], str]] = (),
) -> DataFrame:
    """Patient days without test rows and repeats, mapped, labelled and placed in the calendar.

    Map columns: programs (program, facility, location, grp), payors and discharges (key, grp).
    """
    kept = S.drop_test_rows(raw, "casefile_id", ["first_name", "last_name", "mr_number"], list(allow))
    one = D.latest(kept, ["casefile_id", "census_date", "facility"], ["extraction_timestamp"], ["mr_number"])
    one = one.withColumn("discharge_type", text.plain_punctuation(F.col("discharge_type")))
    out = M.map_with_wildcard(one, programs, ["program", "facility", "location_name"], ["program", "facility", "location"], "grp", "program_group")
    out = M.map_values(out, payors, "insurance_company", "key", "grp", "payor_group", blank="Other")
    out = M.map_values(out, discharges, "discharge_type", "key", "grp", "discharge_group")
    # an unknown discharge text only counts as unmapped once the discharge has a date
    unknown = (F.col("discharge_group") == M.UNMAPPED) & F.col("discharge_date").isNull()
    d = F.col("census_date")
    out = out.withColumns(
        {
            "discharge_group": F.when(~F.coalesce(unknown, F.lit(False)), F.col("discharge_group")), "day_of_week": F.date_format(d, "EEEE"),
            "month": F.date_format(d, "yyyy-MM"), "week_ending": dates.week_ending_strict(d), "year": F.year(d),
        }
    )
    return out.withColumn("budget_category", rules.budget_category(budget_rules))


def census_status(clean: DataFrame) -> DataFrame:
    return Q.status_row(
        clean,
        {"unmapped_program_days": F.col("program_group") == M.UNMAPPED, "unmapped_payor_days": F.col("payor_group") == M.UNMAPPED,
         "unmapped_discharge_days": F.col("discharge_group") == M.UNMAPPED},
    )


# ---- weekly attribution and points ---------------------------------------------------------


def attribute_admits(admits: DataFrame, opps: DataFrame, sites: Mapping[str, str], threshold: int = 88) -> DataFrame:
    """Each admission with its CRM opportunity inside the same site (ids, names, similar names)."""
    base = admits.withColumns(
        {
            "_site": rules.lookup(F.lower(F.trim("location_name")), sites), "_mr": F.trim("mr_number"),
            "_name": F.lower(F.trim(F.concat_ws(" ", F.coalesce("first_name", F.lit("")), F.coalesce("last_name", F.lit(""))))),
        }
    )
    cand = opps.withColumns(
        {
            "_csite": F.lower(F.trim("treatment_program")), "_cmr": F.trim("mr_number"),
            "_cname": F.lower(F.trim(text.strip_number_suffix(F.col("account_name")))),
        }
    ).withColumnRenamed("mr_number", "crm_mr_number")
    prefer = [(F.lower("sales_stage") == "admitted").desc_nulls_last(), F.col("modified_at").desc_nulls_last(), F.col("opportunity_id").asc()]
    carry = ["opportunity_id", "sales_stage", "treatment_program", "vob_status", "lead_type", "referral_source", "opener", "closer"]
    out = block_match(
        base, cand, base_block="_site", cand_block="_csite", base_id_key="_mr", cand_id_key="_cmr", base_name="_name", cand_name="_cname",
        prefer=prefer, carry=carry, threshold=threshold,
    )
    return out.drop("_site", "_mr", "_name")


def admit_events(attributed: DataFrame, reps: Sequence[str], inpatient: Sequence[str], outpatient: Sequence[str], partners: Sequence[str]) -> DataFrame:
    """Scored events of active reps; the id repeats when the job does."""
    ok = attributed.where(~F.col("match_method").startswith("no match") & F.col("closer").isin(*reps))
    s = P.score_admits(ok, "location_name", "vob_status", "lead_type", "referral_source", inpatient, outpatient, partners)
    return s.select(
        P.event_id(F.lit("admit"), F.col("mr_number"), F.col("admission_date"), F.col("opportunity_id")).alias("event_id"), F.lit("admit").alias("event_type"),
        F.col("closer").alias("rep"), "mr_number", F.col("location_name").alias("site"), "tier", "colour", "category", "points", F.col("admission_date").alias("event_date"),
    )


def keep_events(events: DataFrame, table: str, window: dates.Window, path: str | None = None) -> None:
    """Replace the window's events in the event table."""
    W.replace_range(events, table, "event_date", window.start, window.end, path)
