"""Time-intelligence measures as group-by functions of (frame, keys, anchor)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """Quotient; NULL for a zero or missing denominator."""
    return F.try_divide(a, F.nullif(b, F.lit(0)))


def change(cur: Column, prev: Column) -> Column:
    """Relative change; NULL without a prior value."""
    return ratio(F.coalesce(cur, F.lit(0)) - prev, prev)


def conditional(df: DataFrame, keys: Sequence[str], sums: Mapping[str, tuple[Column, Column]] | None = None,
                counts: Mapping[str, Column] | None = None, distinct: Mapping[str, Column] | None = None,
                means: Mapping[str, Column] | None = None, medians: Mapping[str, Column] | None = None) -> DataFrame:
    """Plain, filtered, distinct, mean and median measures per key.

    Several distinct counts in one aggregate would send every row once per count. Each is a narrow aggregate of its own instead, of
    its column only, met with the others by key; ``df`` is read again for it, so store a frame that is costly to compute.
    """
    aggs = [F.sum(F.when(c, v)).alias(n) for n, (v, c) in (sums or {}).items()]
    aggs += [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (counts or {}).items()]
    aggs += [F.avg(c).alias(n) for n, c in (means or {}).items()]
    aggs += [F.median(c).alias(n) for n, c in (medians or {}).items()]
    apart = dict(distinct or {})
    if len(apart) < 2 or not keys:
        aggs += [F.count_distinct(c).alias(n) for n, c in apart.items()]
        apart = {}
    out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    for n, c in apart.items():
        one = df.select(*keys, c.alias("_v")).where("_v is not null").distinct().groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias(n))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        out = out.join(one, same, "left").drop(*[f"_{k}" for k in keys]).withColumn(n, F.coalesce(n, F.lit(0)))
    return out.select(*keys, *(sums or {}), *(counts or {}), *(distinct or {}), *(means or {}), *(medians or {}))


def anchor_date(maxima: Sequence[DataFrame]) -> DataFrame:
    """One row: latest date over one-row max frames, moved back to a Thursday."""
    both = maxima[0].toDF("d")
    for m in maxima[1:]:
        both = both.unionByName(m.toDF("d"))
    latest = both.agg(F.max("d").alias("latest"))
    back = F.pmod(F.dayofweek("latest") - F.lit(5), F.lit(7))
    return latest.select("latest", F.date_sub("latest", back).alias("anchor"))


def report_thursday(latest: Column) -> Column:
    """The Thursday on or after the latest date."""
    return F.date_add(latest, F.pmod(F.lit(5) - F.dayofweek(latest), F.lit(7)))


def trailing_at(df: DataFrame, keys: Sequence[str], day: str, anchor: object, values: Mapping[str, Column], days: int = 28) -> DataFrame:
    """Trailing window ``(anchor-days, anchor]``, the window before it and the change, in one scan.

    ``anchor`` is a date literal, so the scan keeps only the two windows.
    """
    a = F.lit(anchor).cast("date")
    d = F.col(day)
    now = (d > F.date_sub(a, days)) & (d <= a)
    before = (d > F.date_sub(a, 2 * days)) & (d <= F.date_sub(a, days))
    aggs = []
    for n, v in values.items():
        aggs += [
            F.sum(F.when(now, v)).alias(f"{n}_t"),
            F.sum(F.when(before, v)).alias(f"{n}_p"),
        ]
    out = df.where((d > F.date_sub(a, 2 * days)) & (d <= a)).groupBy(*keys).agg(*aggs)
    for n in values:
        out = out.withColumn(f"{n}_change", change(F.col(f"{n}_t"), F.col(f"{n}_p")))
    return out


def daily_totals(df: DataFrame, keys: Sequence[str], day: Column, values: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys, day.alias("day")).agg(*[F.sum(v).alias(n) for n, v in values.items()])


def rolling(daily: DataFrame, keys: Sequence[str], values: Sequence[str], days: int = 28, lag_days: int = 0) -> DataFrame:
    """Sum over the ``days`` days ending ``lag_days`` before each day, per key.

    Runs on daily totals: a key's window partition has one row per calendar day, however many records.
    """
    n = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(n).rangeBetween(-(days - 1) - lag_days, -lag_days)
    suffix = f"_{days}d" if lag_days == 0 else f"_{days}d_prior"
    return daily.select("*", *[F.sum(v).over(w).alias(f"{v}{suffix}") for v in values])


def previous_period(agg: DataFrame, keys: Sequence[str], period: str, value: str, step: str = "week") -> DataFrame:
    """Value of exactly the week or month before; a gap gives NULL, not the last known value."""
    months = step == "month"
    at = F.add_months(F.col(period), 1) if months else F.date_add(F.col(period), 7)
    prev = agg.select(*[F.col(k).alias(f"_{k}") for k in keys], at.alias("_p"), F.col(value).alias(f"{value}_prev"))
    cond = F.col(period) == F.col("_p")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = agg.join(prev, cond, "left").drop("_p", *[f"_{k}" for k in keys])
    return out.withColumn(f"{value}_change", change(F.col(value), F.col(f"{value}_prev")))


def era_target(tgt: DataFrame, day: object, cut: object, before: str, after: str) -> DataFrame:
    """Monthly and weekly targets of the era a date falls in."""
    era = before if str(day) <= str(cut) else after
    return tgt.where(F.col("era") == era).agg(
        F.sum("admit_target").alias("monthly_admit_target"),
        F.sum("point_target").alias("monthly_point_target"),
        (F.sum("admit_target") / 4).alias("weekly_admit_target"),
        (F.sum("point_target") / 4).alias("weekly_point_target"),
    )


def budget_ytd(budget: DataFrame, category: str | Sequence[str], month: str, value: str, start: str, cutoff: str) -> DataFrame:
    """Mean monthly budget from ``start`` to the cutoff month, and the peak month, per category."""
    span = F.col(month).between(F.lit(start), F.lit(cutoff))
    return budget.groupBy(*([category] if isinstance(category, str) else category)).agg(
        ratio(F.sum(F.when(span, F.col(value))), F.count_if(span)).alias("ytd_budget"), F.max(value).alias("peak_budget")
    )


def variance(df: DataFrame, actual: str, budget: str, prefix: str = "variance") -> DataFrame:
    """Difference and share; NULL unless both sides are present."""
    both = F.col(actual).isNotNull() & F.col(budget).isNotNull()
    d = F.when(both, F.col(actual) - F.col(budget))
    return df.withColumn(prefix, d).withColumn(f"{prefix}_pct", ratio(d, F.col(budget)))
