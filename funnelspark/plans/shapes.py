"""Readings of the sample tables as calls, opportunities, admissions, census, spend and finance.

Each shape is a Spark frame and the same thing as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.operators.calls import add_callbacks, classify_calls
from funnelspark.operators.dedupe import latest
from funnelspark.plans.registry import Tables

#: Clock of the call queries: 2024-01-30 00:00 UTC.
AS_OF_UNIX = 1706572800
REPORT_DAY = "2024-01-29"

SOURCES = {
    0: "Google Ads Search",
    1: "PPC  Alpha",
    2: "Organic GMB",
    3: "Referral Partner",
    4: "Direct Line",
    5: "AI Agent",
    6: "Outbound Calls",
    7: "",
}
LABELS = {
    0: "North Outbound",
    1: "Alpha GMB listing",
    2: "Facebook CTA",
    3: "unused",
    4: "main line",
    5: "Billboard 7",
    6: None,
}


def _case(col: str, table: dict) -> str:
    rows = " ".join(f"WHEN {k} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for k, v in table.items())
    return f"CASE {col} {rows} END"


def _pick(table: dict, position: Column) -> Column:
    """Value at a position of a literal list: the position is computed once, not once per branch."""
    return F.element_at(F.array(*[F.lit(v) for v in table.values()]), position + 1)


def _with_k(t: Tables) -> DataFrame:
    """Events with the number of their JSON text."""
    return t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def epoch_seconds(ts: str):
    return F.unix_timestamp(F.col(ts).cast("timestamp"))


def calls(t: Tables) -> DataFrame:
    """Events as call records: error = missed call, purchase = outbound call, signup = form."""
    e = _with_k(t)
    kind = F.col("event_type")
    status = F.expr(
        "CASE event_type WHEN 'view' THEN 'answered' WHEN 'click' THEN 'hangup' WHEN 'error' THEN 'no answer' "
        "WHEN 'purchase' THEN CASE WHEN k >= 30 THEN 'answered' ELSE 'busy' END ELSE 'received' END"
    )
    return e.select(
        F.col("event_id").alias("id"),
        epoch_seconds("ts").alias("unix_time"),
        F.col("ts").cast("date").alias("call_date"),
        "user_id",
        "k",
        "value",
        F.concat(F.lit("n"), F.col("user_id").cast("string")).alias("caller_number"),
        (F.col("user_id") % 3).alias("account_id"),
        F.when(kind == "signup", "form").when(kind == "purchase", "outbound").otherwise("inbound").alias("direction"),
        status.alias("status"),
        F.when(kind != "error", F.floor("value").cast("int")).alias("talk_time"),
        (F.col("k") % 25).alias("ring_time"),
        F.concat(F.lit("agent-"), (F.col("user_id") % 10).cast("string")).alias("agent_id"),
        F.concat(F.lit("Agent "), F.expr("chr(int(65 + user_id % 10))"), F.lit(" Smith")).alias("agent_name"),
        _pick(SOURCES, F.col("k") % 8).alias("source"),
        _pick(LABELS, F.col("k") % 7).alias("tracking_label"),
        (F.col("k") % 4 == 0).alias("is_new_caller"),
        F.concat(F.lit("S"), (F.col("user_id") % 12).cast("string")).alias("state"),
        F.concat(F.lit("site"), (F.col("user_id") % 4).cast("string")).alias("facility"),
    )


def full_calls(t: Tables) -> DataFrame:
    """Classified calls with callback attributes."""
    return add_callbacks(classify_calls(calls(t)), AS_OF_UNIX)


def opportunities(t: Tables) -> DataFrame:
    """Orders with their customer as CRM opportunities."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.select(
        F.col("o_orderkey").alias("opportunity_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("date").alias("created_day"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Admitted' WHEN 'O' THEN 'Open' ELSE 'Pending' END").alias("stage"),
        F.expr(
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Approved - Green' WHEN '2-HIGH' THEN 'Approved - Yellow' "
            "WHEN '3-MEDIUM' THEN 'Approved - Red' WHEN '4-NOT SPECIFIED' THEN 'Approved - Purple' ELSE 'Self Pay' END"
        ).alias("vob_status"),
        F.col("c_mktsegment").alias("program"),
        F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'BD' WHEN 1 THEN 'Alumni' WHEN 2 THEN 'Step Down' ELSE 'SEO' END").alias(
            "lead_type"
        ),
        F.expr("'rep-' || (o_custkey % 12)").alias("closer"),
        F.expr("'rep-' || (o_orderkey % 12)").alias("opener"),
        F.expr("'Client ' || c_name").alias("client_name"),
        F.col("o_totalprice").alias("amount"),
        F.col("c_nationkey").alias("nationkey"),
    )


def census_rows(t: Tables) -> DataFrame:
    """Events as patient-day extracts, with repeats."""
    return _with_k(t).select(
        "event_id",
        "ts",
        F.expr("'C' || user_id").alias("casefile_id"),
        F.col("ts").cast("date").alias("census_date"),
        F.expr("'F' || (user_id % 5)").alias("facility"),
        F.col("event_type").alias("program"),
        F.expr("'P' || (k % 3)").alias("payor"),
        F.expr("CASE WHEN k % 10 = 0 THEN 'AMA' WHEN k % 10 = 1 THEN 'Completed' END").alias("discharge_type"),
        F.expr("CASE WHEN k % 10 < 2 THEN CAST(ts AS DATE) END").alias("discharge_date"),
        F.trunc(F.col("ts").cast("date"), "week").alias("admission_date"),
    )


def census(t: Tables) -> DataFrame:
    """One row per casefile, day and facility: the latest extract."""
    return latest(census_rows(t), ["casefile_id", "census_date", "facility"], ["ts"], ["event_id"])


def spend(t: Tables) -> DataFrame:
    """Line items as daily ad spend."""
    return t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("campaign_id"),
        F.col("l_linenumber").alias("account_id"),
        F.expr(
            "CASE l_returnflag WHEN 'R' THEN 'Pmax - alpha' WHEN 'A' THEN 'S|beta-gdn' ELSE 'brand gamma' END"
        ).alias("campaign_name"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'Main Account' ELSE 'Shared' END").alias("account_name"),
        F.col("l_extendedprice").alias("cost"),
        F.col("l_partkey").cast("double").alias("impressions"),
        F.col("l_quantity").alias("clicks"),
        F.col("l_discount").alias("conversions"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("conversions_value"),
    )


def bank(t: Tables) -> DataFrame:
    """Line items as bank rows: revenue positive, costs negative, some transfers."""
    return t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'E1' ELSE 'E2' END").alias("entity"),
        F.expr(
            "CASE WHEN l_tax >= 0.07 THEN 'Transfer' WHEN l_returnflag = 'R' THEN 'Revenue' "
            "WHEN l_returnflag = 'A' THEN 'Salaries and Wages' ELSE 'Other Expenses' END"
        ).alias("type"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE -l_extendedprice END").alias("amount"),
        F.expr("'ship ' || l_returnflag || l_linestatus || ' va'").alias("description"),
    )


def historical(t: Tables) -> DataFrame:
    """Orders per month as rows of an older ledger."""
    o = t.orders.select(
        F.last_day(F.col("o_orderdate").cast("date")).alias("month_ending"),
        F.lit("E3").alias("entity"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Revenue' WHEN 'O' THEN 'Salaries and Wages' ELSE 'Other Expenses' END").alias(
            "type"
        ),
        F.col("o_totalprice").alias("amount"),
    )
    return o.groupBy("month_ending", "entity", "type").agg(F.sum("amount").alias("amount"))


def budget(t: Tables) -> DataFrame:
    """Orders per month as budget rows."""
    o = t.orders.select(
        F.last_day(F.col("o_orderdate").cast("date")).alias("month_ending"),
        F.expr("'E' || (1 + o_custkey % 2)").alias("entity"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Revenue' WHEN 'O' THEN 'Salaries and Wages' ELSE 'EBITDA' END").alias("type"),
        F.col("o_totalprice").alias("amount"),
    )
    return o.groupBy("month_ending", "entity", "type").agg(F.sum("amount").alias("amount"))


#: name -> (sql, names it builds on)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "calls": (
        f"""
        SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS unix_time, CAST(ts AS DATE) AS call_date,
               user_id, k, value, 'n' || user_id AS caller_number, user_id % 3 AS account_id,
               CASE event_type WHEN 'signup' THEN 'form' WHEN 'purchase' THEN 'outbound' ELSE 'inbound' END AS direction,
               CASE event_type WHEN 'view' THEN 'answered' WHEN 'click' THEN 'hangup' WHEN 'error' THEN 'no answer'
                    WHEN 'purchase' THEN CASE WHEN k >= 30 THEN 'answered' ELSE 'busy' END ELSE 'received' END AS status,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INTEGER) END AS talk_time,
               k % 25 AS ring_time, 'agent-' || (user_id % 10) AS agent_id,
               'Agent ' || chr(CAST(65 + user_id % 10 AS INTEGER)) || ' Smith' AS agent_name,
               {_case('k % 8', SOURCES)} AS source, {_case('k % 7', LABELS)} AS tracking_label,
               k % 4 = 0 AS is_new_caller, 'S' || (user_id % 12) AS state, 'site' || (user_id % 4) AS facility
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
        """,
        (),
    ),
    "classified": (
        """
        SELECT *, outcome IN ('missed', 'voicemail', 'abandoned_on_hold') AS needs_callback,
               outcome IN ('missed', 'voicemail', 'abandoned_on_hold') AS is_inbound_missed
        FROM (
          SELECT *, event_type = 'voice' AS is_voice,
            CASE WHEN event_type = 'voice' AND status = 'answered' AND talk_time > 0 THEN 'answered'
                 WHEN event_type = 'voice' AND status = 'answered' AND talk_time = 0 THEN 'voicemail'
                 WHEN event_type = 'voice' AND direction = 'inbound' AND status = 'hangup' AND ring_time < 10 THEN 'quick_hangup'
                 WHEN event_type = 'voice' AND direction = 'inbound' AND status = 'hangup' AND ring_time >= 10 THEN 'abandoned_on_hold'
                 WHEN event_type = 'voice' AND direction = 'inbound' AND status IN ('no answer','busy','canceled','failed','unreachable') THEN 'missed'
                 WHEN event_type = 'voice' AND direction = 'outbound' AND status IN ('no answer','busy','canceled','failed','unreachable') THEN 'no_contact'
                 ELSE 'other' END AS outcome
          FROM (SELECT *, CASE WHEN direction IN ('msg_inbound','msg_outbound') THEN 'sms' WHEN direction = 'form' THEN 'form_fill'
                          WHEN direction = 'chat' THEN 'chat' WHEN direction IN ('inbound','outbound') THEN 'voice' ELSE 'other' END AS event_type
                FROM calls))
        """,
        ("calls",),
    ),
    "callback": (
        """
        SELECT m.id, o.id AS cb_id, o.unix_time AS cb_t, o.agent_id AS cb_agent, o.outcome AS cb_outcome
        FROM classified m JOIN classified o ON m.caller_number = o.caller_number
             AND o.unix_time > m.unix_time AND o.unix_time <= m.unix_time + 604800
        WHERE m.needs_callback AND o.event_type = 'voice' AND o.direction = 'outbound'
              AND coalesce(o.talk_time, 0) + coalesce(o.ring_time, 0) >= 30
        QUALIFY row_number() OVER (PARTITION BY m.id ORDER BY o.unix_time, o.id) = 1
        """,
        ("classified",),
    ),
    "full_calls": (
        f"""
        SELECT *, CASE WHEN NOT needs_callback THEN NULL
                       WHEN callback_status IN ('pending', 'not_called_back') THEN callback_status
                       WHEN callback_minutes < 15 THEN '<15min' WHEN callback_minutes < 60 THEN '15min-1hr'
                       WHEN callback_minutes < 1440 THEN '1hr-24hr' ELSE '1d-7d' END AS callback_bucket
        FROM (
          SELECT c.*, CASE WHEN NOT needs_callback THEN 'no_callback_needed' WHEN cb_id IS NOT NULL THEN 'called_back'
                           WHEN unix_time > {AS_OF_UNIX - 86400} THEN 'pending' ELSE 'not_called_back' END AS callback_status,
                 cb_id AS callback_call_id, (cb_t - unix_time) // 60 AS callback_minutes, cb_agent AS callback_by_agent_id,
                 CASE WHEN cb_id IS NOT NULL THEN cb_agent = agent_id END AS callback_by_same_agent,
                 CASE WHEN cb_id IS NOT NULL THEN cb_outcome = 'answered' END AS callback_connected
          FROM classified c LEFT JOIN callback USING (id))
        """,
        ("classified", "callback"),
    ),
    "opps": (
        """
        SELECT o_orderkey AS opportunity_id, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS created_day,
               CASE o_orderstatus WHEN 'F' THEN 'Admitted' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS stage,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Approved - Green' WHEN '2-HIGH' THEN 'Approved - Yellow'
                    WHEN '3-MEDIUM' THEN 'Approved - Red' WHEN '4-NOT SPECIFIED' THEN 'Approved - Purple' ELSE 'Self Pay' END AS vob_status,
               c_mktsegment AS program,
               CASE o_orderkey % 4 WHEN 0 THEN 'BD' WHEN 1 THEN 'Alumni' WHEN 2 THEN 'Step Down' ELSE 'SEO' END AS lead_type,
               'rep-' || (o_custkey % 12) AS closer, 'rep-' || (o_orderkey % 12) AS opener, 'Client ' || c_name AS client_name,
               o_totalprice AS amount, c_nationkey AS nationkey
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        """,
        (),
    ),
    "census_rows": (
        """
        SELECT event_id, ts, 'C' || user_id AS casefile_id, CAST(ts AS DATE) AS census_date, 'F' || (user_id % 5) AS facility,
               event_type AS program, 'P' || (k % 3) AS payor,
               CASE WHEN k % 10 = 0 THEN 'AMA' WHEN k % 10 = 1 THEN 'Completed' END AS discharge_type,
               CASE WHEN k % 10 < 2 THEN CAST(ts AS DATE) END AS discharge_date,
               CAST(date_trunc('week', ts) AS DATE) AS admission_date
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
        """,
        (),
    ),
    "census": (
        """
        SELECT * FROM census_rows
        QUALIFY row_number() OVER (PARTITION BY casefile_id, census_date, facility ORDER BY ts DESC, event_id) = 1
        """,
        ("census_rows",),
    ),
    "spend": (
        """
        SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id, l_linenumber AS account_id,
               CASE l_returnflag WHEN 'R' THEN 'Pmax - alpha' WHEN 'A' THEN 'S|beta-gdn' ELSE 'brand gamma' END AS campaign_name,
               CASE l_linestatus WHEN 'F' THEN 'Main Account' ELSE 'Shared' END AS account_name,
               l_extendedprice AS cost, CAST(l_partkey AS DOUBLE) AS impressions, l_quantity AS clicks, l_discount AS conversions,
               l_extendedprice * (1 - l_discount) AS conversions_value
        FROM lineitem
        """,
        (),
    ),
    "bank": (
        """
        SELECT CAST(l_shipdate AS DATE) AS date, CASE l_linestatus WHEN 'F' THEN 'E1' ELSE 'E2' END AS entity,
               CASE WHEN l_tax >= 0.07 THEN 'Transfer' WHEN l_returnflag = 'R' THEN 'Revenue'
                    WHEN l_returnflag = 'A' THEN 'Salaries and Wages' ELSE 'Other Expenses' END AS type,
               CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE -l_extendedprice END AS amount
        FROM lineitem
        """,
        (),
    ),
    "historical": (
        """
        SELECT last_day(CAST(o_orderdate AS DATE)) AS month_ending, 'E3' AS entity,
               CASE o_orderstatus WHEN 'F' THEN 'Revenue' WHEN 'O' THEN 'Salaries and Wages' ELSE 'Other Expenses' END AS type,
               sum(o_totalprice) AS amount
        FROM orders GROUP BY ALL
        """,
        (),
    ),
    "budget": (
        """
        SELECT last_day(CAST(o_orderdate AS DATE)) AS month_ending, 'E' || (1 + o_custkey % 2) AS entity,
               CASE o_orderstatus WHEN 'F' THEN 'Revenue' WHEN 'O' THEN 'Salaries and Wages' ELSE 'EBITDA' END AS type,
               sum(o_totalprice) AS amount
        FROM orders GROUP BY ALL
        """,
        (),
    ),
    "fin_monthly": (
        """
        SELECT last_day(date) AS month_ending, entity, type,
               CASE WHEN type = 'Revenue' THEN sum(amount) ELSE -sum(amount) END AS amount, 'Bank Actuals' AS source
        FROM bank WHERE type IN ('Revenue', 'Salaries and Wages', 'Other Expenses') GROUP BY last_day(date), entity, type
        UNION ALL SELECT month_ending, entity, type, amount, 'Historical' FROM historical
        """,
        ("bank", "historical"),
    ),
}
