"""Patient-day census: admissions, length of stay, average daily census."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_test_rows(df: DataFrame, id_col: str, text_cols: Sequence[str], allow: Sequence[str], word: str = "test") -> DataFrame:
    """Remove rows whose texts contain ``word`` unless the id is allow-listed.

    Three-valued: a NULL text makes the test unknown and drops the row, allow-listed ids excepted.
    """
    clean = F.lit(True)
    for c in text_cols:
        clean = clean & ~F.lower(F.col(c)).contains(word)
    keep = F.col(id_col).isin(*allow) if allow else F.lit(False)
    return df.where(keep | clean)


def backfill_last(df: DataFrame, keys: Sequence[str], day: str, fill: Sequence[str], tie: str) -> DataFrame:
    """Last row per key by day with each ``fill`` column replaced by its last filled value.

    An aggregate combined before the shuffle, not a window over the whole group.
    """
    order = F.struct(day, tie)
    others = [c for c in df.columns if c not in keys and c not in fill]
    filled = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in fill
    ]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_last"), *filled)
    return out.select(*keys, "_last.*", *fill)


def length_of_stay(admissions: DataFrame, last_extract: Column, admitted: str, discharged: str, last_seen: str) -> DataFrame:
    """Stay in days; an open stay not seen on the last extract gets its last census date as discharge."""
    dropped = F.col(discharged).isNull() & (F.col(last_seen) < last_extract)
    end = F.when(dropped, F.col(last_seen)).otherwise(F.col(discharged))
    return (
        admissions.withColumn("dropped_out", dropped)
        .withColumn("discharge_final", end)
        .withColumn("los_days", F.datediff(F.col("discharge_final"), F.col(admitted)))
    )


def last_day_of(census: DataFrame, day: str) -> Column:
    """Latest census date of the whole table as a scalar subquery column."""
    return census.agg(F.max(day)).scalar()


def coverage(df: DataFrame, keys: Sequence[str], entity: str, day: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("patient_days"),
        F.count_distinct(entity).alias("unique_ids"),
        F.min(day).alias("from_date"),
        F.max(day).alias("to_date"),
    )


def weekly_census(census: DataFrame, week: str, day: str, site: Sequence[str], split: Sequence[str] = ()) -> DataFrame:
    """Average daily census per week, site and segment.

    The denominator is the number of distinct census dates of the week and site, whatever the segment, so
    segments add up to the site. A segment absent in a week of its site counts 0 there. Day counts are
    aggregated first; both later grains work on that small table.
    """
    keys = [*site, *split]
    daily = census.groupBy(week, day, *keys).agg(F.count(F.lit(1)).alias("n"))
    dates = daily.groupBy(week, *site).agg(F.count_distinct(day).alias("dates"))
    rows = daily.groupBy(week, *keys).agg(F.sum("n").alias("rows"))
    segments = rows.select(*keys).distinct()
    grid = dates
    if split:
        named = segments.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(site)], *split)
        same = [dates[c].eqNullSafe(named[f"_s{i}"]) for i, c in enumerate(site)]
        grid = dates.join(named, same).drop(*[f"_s{i}" for i in range(len(site))])
    # Counts and grid meet in one sum, where NULL segments are equal.
    cells = grid.withColumn("rows", F.lit(0).cast("long")).unionByName(rows.withColumn("dates", F.lit(None).cast("long")))
    cells = cells.groupBy(week, *keys).agg(F.sum("rows").alias("rows"), F.max("dates").alias("dates"))
    return cells.withColumn("adc", F.col("rows") / F.col("dates"))


def average_census(weekly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of the weekly values, absent weeks counting 0."""
    return weekly.groupBy(*keys).agg(F.avg("adc").alias("adc"), F.count(F.lit(1)).alias("weeks"))


_LEVELS = ("site and segment", "site", "segment", "total")


def _by_level(cells: DataFrame, keys: Sequence[str], site: str, segment: str, value: str) -> DataFrame:
    """Sums of ``value`` per ``keys`` at four levels: site and segment, site, segment, total. A rolled-up column is NULL; ``level`` tells."""
    sets = [[*keys, site, segment], [*keys, site], [*keys, segment], [*keys]]
    which = F.grouping(site) * 2 + F.grouping(segment)
    # grouping bits: 0 both kept, 1 segment rolled up, 2 site rolled up, 3 both
    level = F.element_at(F.array(*map(F.lit, _LEVELS)), which.cast("int") + 1)
    return cells.groupingSets(sets, *keys, site, segment).agg(F.sum(value).alias(value), level.alias("level"))


def census_frame(
    census: DataFrame, budget: DataFrame, *, week: str, month: str, day: str, site: str, segment: str, amount: str, start: str, cutoff: str
) -> DataFrame:
    """Average daily census by site and segment, site, segment and in total, beside its budget: one row per member of each level.

    ``actual`` and ``budget`` are those of the month ``cutoff``; the year to date runs from ``start`` to ``cutoff``. Actuals are means of weekly
    values whose denominator is the census dates of week and site, so segments and sites add up; budgets of a level are sums of its
    members, the year to date their mean over months, ``peak_budget`` the largest month of all. A member known to one side only
    has NULL on the other, and variances need both.
    """
    def actual(rows: DataFrame, name: str) -> DataFrame:
        cells = weekly_census(rows, week, day, [site], [segment])
        return _by_level(cells, [week], site, segment, "adc").groupBy("level", site, segment).agg(F.avg("adc").alias(name))

    span = F.col(month).between(start, cutoff)
    months = _by_level(budget, [month], site, segment, amount)
    planned = months.groupBy("level", site, segment).agg(
        F.max(F.when(F.col(month) == cutoff, F.col(amount))).alias("budget"), F.avg(F.when(span, F.col(amount))).alias("ytd_budget"), F.max(amount).alias("peak_budget")
    )
    names = ["actual", "ytd_actual", "budget", "ytd_budget", "peak_budget"]
    out = None
    for part in (actual(census.where(F.col(month) == cutoff), "actual"), actual(census.where(span), "ytd_actual"), planned):
        part = part.select("level", site, segment, *(F.col(n) if n in part.columns else F.lit(None).cast("double").alias(n) for n in names))
        out = part if out is None else out.union(part)
    # The three meet in one sum, where rolled-up and NULL members are equal.
    out = out.groupBy("level", site, segment).agg(*(F.max(n).alias(n) for n in names))
    for now, plan, name in (("actual", "budget", "variance"), ("ytd_actual", "ytd_budget", "ytd_variance")):
        gap = F.col(now) - F.col(plan)
        out = out.withColumns({name: gap, f"{name}_pct": F.try_divide(gap, F.nullif(F.col(plan), F.lit(0)))})
    return out


def utilisation(adc: DataFrame, beds: Mapping[str, int], site: str) -> DataFrame:
    """ADC over licensed beds; a site without a bed count stays NULL."""
    n = F.create_map(*[F.lit(x) for kv in beds.items() for x in kv])[F.col(site)]
    return adc.withColumn("beds", n).withColumn("utilisation", F.try_divide(F.col("adc"), n))


def weekly_admits(census: DataFrame, entity: str, day: str, week: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Entities by the week of their first census date over all data."""
    first = census.groupBy(entity).agg(F.min(day).alias("first_day"), *[F.min_by(k, day).alias(k) for k in keys])
    return first.groupBy(week.alias("week_ending"), *keys).agg(F.count(F.lit(1)).alias("admits"))


def average_stay(census: DataFrame, entity: str, admitted: str, discharged: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of first discharge minus first admission over distinct discharged entities."""
    one = census.groupBy(entity, *keys).agg(F.min(admitted).alias("_a"), F.min(discharged).alias("_d"))
    return one.where(F.col("_d").isNotNull()).groupBy(*keys).agg(
        F.avg(F.datediff("_d", "_a")).alias("avg_los"), F.count(F.lit(1)).alias("discharges")
    )
