"""Stage funnels: counts of several stages aligned on one key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.operators.dedupe import latest


def funnel(stages: Mapping[str, tuple[DataFrame, Column]], keys: Sequence[str]) -> DataFrame:
    """Zero-filled stage counts per key.

    Each stage is (frame with the key columns, condition to count). The stage rows are stacked and counted
    in one aggregate: one shuffle instead of a chain of full outer joins, and rows whose key holds NULL
    still meet each other. Stages given the same frame are counted in one pass over it.
    """
    names = list(stages)
    frames: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for name, (df, cond) in stages.items():
        frames.setdefault(id(df), (df, {}))[1][name] = cond
    zero = F.lit(0).cast("long")
    parts = [
        df.select(*keys, *[(F.coalesce(conds[n], F.lit(False)).cast("long") if n in conds else zero).alias(n) for n in names])
        for df, conds in frames.values()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def align_stages(frames: Sequence[DataFrame], keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full outer join of aggregated stages, zero-filled.

    Keys compare with plain equality here, so a NULL key part keeps the stages apart; :func:`funnel` does not.
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, list(keys), "full_outer")
    return out.select(*keys, *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


def align_on(left: DataFrame, right: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Outer join of two aggregates on one key, zero-filled."""
    return align_stages([left, right], [key], values)


def entity_volume(df: DataFrame, key: str, modified: str, created: str, period: Column, tie: Sequence[str] = ()) -> DataFrame:
    """Distinct entities per period after keeping the latest snapshot row of each."""
    one = latest(df, [key], [modified], tie).where(F.col(created).isNotNull())
    return one.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("entities"))


def stage_counts(df: DataFrame, dims: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Rows and true flags per dimension."""
    return df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()]
    )


def stage_flags(vob_status: Column, viable: Column, stage: Column) -> dict[str, Column]:
    """has_vob, is_viable and is_admit from status texts; never NULL."""
    return {
        "has_vob": F.coalesce((F.trim(vob_status) != "") & (F.lower(vob_status) != "pending"), F.lit(False)),
        "is_viable": F.coalesce(viable.isin("Viable VOBs", "Admits"), F.lit(False)),
        "is_admit": F.lower(F.coalesce(stage, F.lit(""))) == "admitted",
    }


def cohort_date(matched_day: Column, created: Column) -> Column:
    return F.coalesce(matched_day, created.cast("date"))
