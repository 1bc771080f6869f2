"""Schema checks, coverage and fill-rate profiles, data status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def assert_schema(df: DataFrame, fields: Sequence[str], struct: str | None = None, non_empty: bool = False) -> DataFrame:
    """Raise early when required fields are missing (or no row exists); returns the frame unchanged."""
    schema = df.schema if struct is None else df.schema[struct].dataType
    names = set(schema.fieldNames()) if isinstance(schema, T.StructType) else set()
    missing = sorted(set(fields) - names)
    if missing:
        raise ValueError(f"required fields missing: {missing}; seen: {sorted(names)[:40]}")
    if non_empty and df.isEmpty():
        raise ValueError("no rows were read")
    return df


def assert_same_count(before: DataFrame, after: DataFrame) -> None:
    """Row-count invariant of a left join; two counts, for tests and audits."""
    n, m = before.count(), after.count()
    if n != m:
        raise AssertionError(f"row count drift: {n} became {m}")


def date_coverage(df: DataFrame, keys: Sequence[str], day: str, low: int = 10) -> DataFrame:
    """Every day between each key's first and last day with its count and a zero / low / ok mark.

    The expected days are generated per key from its own range: no calendar join, no driver loop.
    """
    daily = df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("events"))
    spans = daily.groupBy(*keys).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    expected = spans.select(*keys, F.explode(F.sequence("_a", "_b")).alias(day), F.lit(0).cast("long").alias("events"))
    # Counts and expected days meet in one sum, where NULL keys are equal.
    out = expected.unionByName(daily.where(F.col(day).isNotNull())).groupBy(*keys, day).agg(F.sum("events").alias("events"))
    mark = F.when(F.col("events") == 0, F.lit("zero")).when(F.col("events") < low, F.lit("low")).otherwise(F.lit("ok"))
    return out.withColumn("status", mark)


def fill_profile(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and filled counts per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"{c}_filled") for c in columns])


def name_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Matched, Unknown and NULL counts of canonicalised name columns, one row per column, one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns])
    return (
        df.select(F.explode(cells).alias("x"))
        .groupBy("x.column")
        .agg(
            F.count_if(F.coalesce(F.col("x.v") != "Unknown", F.lit(False))).alias("matched"),
            F.count_if(F.coalesce(F.col("x.v") == "Unknown", F.lit(False))).alias("unknown"),
            F.count_if(F.col("x.v").isNull()).alias("missing"),
        )
    )


def match_profile(df: DataFrame, keys: Sequence[str], linked: Column, confidence: str) -> DataFrame:
    """Linked, high and low confidence counts with the link percentage."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(linked).alias("linked"),
        F.count_if(F.col(confidence) == "high").alias("high_conf"),
        F.count_if(F.col(confidence) == "low").alias("low_conf"),
    ).withColumn("link_pct", F.round(100.0 * F.col("linked") / F.col("rows"), 1))


def status_row(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: unmapped counts, row total and a status text."""
    agg = df.agg(
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()], F.count(F.lit(1)).alias("total_rows")
    )
    issues = F.lit(0)
    for n in checks:
        issues = issues + F.col(n)
    return agg.withColumn("data_status", F.when(issues > 0, F.lit("ISSUES FOUND")).otherwise(F.lit("ALL CLEAN")))
