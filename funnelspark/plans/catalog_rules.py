"""Queries of the rules kept as tables; they give what the ``CASE`` forms in ``catalog_functions`` give."""

from __future__ import annotations

from pyspark.sql import functions as F

from funnelspark.functions import rules, text
from funnelspark.operators.rule_table import label_by_rules, pattern_rules, rule_frame
from funnelspark.plans import shapes
from funnelspark.plans.catalog_functions import BRIEF_SQL, CHANNEL_SQL
from funnelspark.plans.registry import REGISTRY, query


def _with_names(patterns, names):
    """Rules of ``patterns``, then the names as whole texts that count as Direct."""
    return pattern_rules(patterns) + [(len(patterns), n, "whole", "Direct") for n in names]


@query(
    "k16_channel_table", "channel:s brief:s n:i",
    sql=f"SELECT {CHANNEL_SQL} AS channel, {BRIEF_SQL} AS brief, count(*) AS n FROM calls GROUP BY 1, 2",
    uses=["calls"],
)
def k16_table(t):
    names = ("main line", "north")
    calls = shapes.calls(t).select(text.collapse_spaces(F.col("tracking_label")).alias("lab"), text.collapse_spaces(F.col("source")).alias("src"))
    named = F.when((F.col("lab") != "") & ~F.col("lab").contains("unused"), F.col("lab"))
    out = label_by_rules(calls, named, rule_frame(t.spark, _with_names(rules.CHANNEL_BY_LABEL, names)), "by_label")
    out = label_by_rules(out, F.col("src"), rule_frame(t.spark, _with_names(rules.CHANNEL_BY_SOURCE, names)), "by_source", "Other")
    out = label_by_rules(out, F.col("src"), rule_frame(t.spark, pattern_rules(rules.BRIEF_CHANNEL_BY_SOURCE)), "brief", "Other")
    return out.groupBy(F.coalesce("by_label", "by_source").alias("channel"), "brief").agg(F.count(F.lit(1)).alias("n"))


@query("k17_lead_type_table", "lead_type:s stored:s n:i", sql=REGISTRY["k17_lead_type"].body, uses=["calls"])
def k17_table(t):
    stored = F.expr("CASE user_id % 5 WHEN 0 THEN ' bd' WHEN 1 THEN 'Step-Down' WHEN 2 THEN 'Ppc' WHEN 3 THEN '' END")
    sign = rules.referred(F.when(F.col("user_id") % 7 == 0, F.lit("partner")).otherwise(F.lit("--")))
    blob = F.lower(F.concat_ws(" ", text.text_or_empty(F.col("source")), text.text_or_empty(F.col("tracking_label"))))
    calls = shapes.calls(t).select(sign.alias("sign"), blob.alias("blob"), F.lower(F.trim(stored)).alias("raw"))
    by_name = [(0, k, "whole", v) for k, v in rules.LEAD_TYPE_NAMES.items()] + [(1, f"step{gap}down", "part", "Step Down") for gap in ("", " ", "-")]
    out = label_by_rules(calls, F.when(~F.col("sign"), F.col("blob")), rule_frame(t.spark, pattern_rules(rules.LEAD_TYPE_PATTERNS)), "by_text", "Other")
    out = label_by_rules(out, F.col("raw"), rule_frame(t.spark, by_name), "stored", "Other")
    return out.groupBy(F.when(F.col("sign"), F.lit("BD")).otherwise(F.col("by_text")).alias("lead_type"), "stored").agg(F.count(F.lit(1)).alias("n"))


@query("k18_label_site_table", "label:s site:s n:i", sql=REGISTRY["k18_label_site"].body, uses=["calls"])
def k18_table(t):
    sites = [(0, "north", "word", "N-site"), (1, "gmb", "word", "A-site"), (1, "alph", "word", "A-site")]
    calls = shapes.calls(t).select(F.col("tracking_label").alias("label"))
    out = label_by_rules(calls, F.lower(text.text_or_empty(F.col("label"))), rule_frame(t.spark, sites), "site", "none")
    return out.groupBy("label", "site").agg(F.count(F.lit(1)).alias("n"))


@query("k19_campaign_map_table", "site:s channel:s n:i", sql=REGISTRY["k19_campaign_map"].body, uses=["spend"])
def k19_table(t):
    name = F.lower(text.text_or_empty(F.col("campaign_name")))
    channels = [(i, n, "token", label) for i, (names, label) in enumerate(rules.CAMPAIGN_CHANNEL_TOKENS) for n in names]
    sites = [(0, "alpha", "token", "Alpha"), (0, "a", "token", "Alpha"), (1, "beta", "token", "Beta")]
    spend = shapes.spend(t).select("campaign_name", F.trim("account_name").alias("account"))
    out = label_by_rules(spend, F.col("account"), rule_frame(t.spark, [(0, "Main Account", "whole", "Main")]), "by_account")
    out = label_by_rules(out, name, rule_frame(t.spark, sites), "by_name", "Unmapped")
    out = label_by_rules(out, name, rule_frame(t.spark, channels), "channel", "Other")
    return out.groupBy(F.coalesce("by_account", "by_name").alias("site"), "channel").agg(F.count(F.lit(1)).alias("n"))
