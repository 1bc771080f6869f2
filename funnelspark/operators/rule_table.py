"""Ordered text rules as a table: what ``functions.rules`` writes as one ``CASE``, for rules by the thousand.

A rule is a row ``(priority, needle, match, label)``; the lowest priority that holds wins. ``match`` says where the needle must
stand: ``part`` (anywhere), ``start``, ``end``, ``whole`` (the whole text), ``word`` (between word boundaries) or ``token``
(between blanks, hyphens and bars). A rule is looked up by one short gram of its needle, the one that fewest texts hold, so a text
meets the few rules that share such a gram with it and the plan is the same for five rules and for five thousand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelspark.operators.intervals import null_spread
from funnelspark.sources.tables import literal_table

MATCHES = ("part", "start", "end", "whole", "word", "token")
RULE_SCHEMA = "priority int, needle string, match string, label string"
#: Longest gram that a rule is looked up by.
GRAM = 3


def pattern_rules(patterns: Sequence[tuple[str, str]], match: str = "part") -> list[tuple[int, str, str, str]]:
    """Rule rows of ordered ``(alternatives, label)``: literals between ``|``, each with ``^`` or ``$`` if it is anchored.

    Anything else of a regular expression is an error, since it has no needle.
    """
    out = []
    for priority, (pattern, label) in enumerate(patterns):
        for part in pattern.split("|"):
            start, end = part.startswith("^"), part.endswith("$")
            needle = part[start : len(part) - end].replace(r"\.", "\0")
            if set(needle) & set(r".^$*+?{}[]()\\"):
                raise ValueError(f"not a literal: {part!r}")
            place = "whole" if start and end else "start" if start else "end" if end else match
            out.append((priority, needle.replace("\0", "."), place, label))
    return out


def rule_frame(spark: SparkSession, rules: Sequence[tuple[int, str, str, str]]) -> DataFrame:
    return literal_table(spark, list(rules), RULE_SCHEMA)


def _grams(text: Column, size: Column) -> Column:
    """Distinct runs of ``size`` characters of ``text`` (one empty run for size 0), without looking at a character more than ``GRAM`` times."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    runs = F.transform(
        F.sequence(F.lit(1), F.size(chars) - size + 1), lambda i: F.array_join(F.slice(chars, i, size), "")
    )
    return F.when(size == 0, F.array(F.lit(""))).when(F.char_length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _holds(text: str, needle: str, match: str) -> Column:
    t, n, m = F.col(text), F.col(needle), F.col(match)
    quoted = F.concat(F.lit(r"\b"), F.regexp_replace(n, r"([^\p{L}\p{N}_ ])", r"\\$1"), F.lit(r"\b"))
    return (
        F.when(m == "part", t.contains(n))
        .when(m == "start", t.startswith(n))
        .when(m == "end", t.endswith(n))
        .when(m == "whole", t == n)
        .when(m == "word", F.rlike(t, quoted))
        .when(m == "token", F.array_contains(F.split(t, r"[ \-|]+"), n))
    )


def rule_matches(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """``_text`` and ``_label`` of every distinct text of the column ``_text`` for which a rule holds.

    The gram lengths in use (at most ``GRAM`` + 1 values) are the only thing that reaches the driver.
    """
    rules = rules.where(F.col("needle").isNotNull() & F.col("match").isin(*MATCHES)).select("priority", "needle", "match", "label").distinct()
    sized = rules.withColumn("_size", F.least(F.char_length("needle"), F.lit(GRAM)))
    sizes = sorted(r["_size"] for r in sized.select("_size").distinct().collect())
    if not sizes:
        return texts.select("_text", F.lit(None).cast("string").alias("_label")).limit(0)
    distinct = texts.where(F.col("_text").isNotNull()).select("_text").distinct()
    held = distinct.select("_text", F.explode(F.concat(*[_grams(F.col("_text"), F.lit(n)) for n in sizes])).alias("_gram"))
    possible = sized.select("*", F.explode(_grams(F.col("needle"), F.col("_size"))).alias("_gram"))
    # Texts per gram, for grams of needles only; a gram that no text holds makes its rule impossible.
    wanted = possible.select("_gram").distinct()
    frequency = held.join(wanted, "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = Window.partitionBy("priority", "needle", "match", "label").orderBy("_n", "_gram")
    keyed = (
        possible.join(frequency, "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
        .withColumn("_place", F.row_number().over(rarest)).where((F.col("_place") == 1) & (F.col("_n") > 0))
        .select("_gram", "priority", "needle", "match", "label")
    )
    hits = held.join(keyed, "_gram").where(_holds("_text", "needle", "match"))
    return hits.groupBy("_text").agg(F.min(F.struct("priority", "label")).alias("_best")).select("_text", F.col("_best.label").alias("_label"))


def label_by_rules(df: DataFrame, text: Column, rules: DataFrame, out: str, default: str | None = None) -> DataFrame:
    """``df`` with the label of the first rule that holds for ``text``; ``default`` where none does.

    Needles are compared as they are, so the caller brings texts and needles to one case. No rule holds for a NULL text. Rules of one
    priority are settled by the least label. Each distinct text is looked up once; labels are joined back, so ``df`` is sent once, or not
    at all where the labels are small enough to be broadcast. A rule without a needle, or of an unknown ``match``, never holds.
    """
    kept = [c for c in df.columns if c != out]
    slot = F.when(text.isNotNull(), F.lit(0)).otherwise(null_spread(df)).cast("long")
    held = df.select(*kept, text.alias("_looked_up"), slot.alias("_slot"))
    found = rule_matches(df.select(text.alias("_text")), rules).select(
        F.col("_text").alias("_rule_text"), F.col("_label").alias("_rule_label"), F.lit(0).cast("long").alias("_rule_slot")
    )
    same = (F.col("_looked_up") == F.col("_rule_text")) & (F.col("_slot") == F.col("_rule_slot"))
    return held.join(found, same, "left").select(*kept, F.coalesce("_rule_label", F.lit(default)).alias(out))
