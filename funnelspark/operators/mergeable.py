"""Distinct counts and quantiles of any window of days from one table a day: bitmaps of dense ids and histograms, which merge.

The daily tables are built once; days, weeks and trailing windows are merged from them, and the events are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.session import materialise


def dense_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id) of every distinct value that is not NULL: ids from 0 without gaps, those of ``known`` kept, stored.

    Values are dealt by hash and numbered inside their deal; the deals' sizes, one row each, give the offsets.
    """
    new = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
    deals = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(new.withColumn("_deal", F.pmod(F.xxhash64("value"), F.lit(deals))), "ids-dealt")
    sizes = dealt.groupBy("_deal").agg(F.count(F.lit(1)).alias("_n"))
    # No partition key: one row a deal, as many as shuffle partitions.
    before = sizes.select("_deal", (F.sum("_n").over(Window.orderBy("_deal")) - F.col("_n")).alias("_before"))
    last = None if known is None else known.agg(F.max("id")).first()[0]
    first = 0 if last is None else last + 1
    inside = F.row_number().over(Window.partitionBy("_deal").orderBy("value"))
    ids = dealt.join(before, "_deal").select("value", (F.lit(first) + F.col("_before") + inside - 1).cast("long").alias("id"))
    return materialise(ids if known is None else known.select("value", "id").union(ids), "ids")


def daily_bitmaps(rows: DataFrame, keys: Sequence[str], day: str, column: str, ids: DataFrame) -> DataFrame:
    """(keys, day, bucket, bits): which ids each day has, 32,768 to a bucket of 4 KB. Rows without a value count for nothing."""
    met = rows.select(*keys, F.col(day).alias("day"), F.col(column).alias("value")).distinct().join(ids, "value")
    return met.groupBy(*keys, "day", F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def _windows(daily: DataFrame, keys: Sequence[str], days: Sequence[int]) -> DataFrame:
    """Daily rows once per day of the key whose longest window holds them: with ``at``, that day, and ``gap``, the days between."""
    at = daily.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("day").alias("at")).distinct()
    spread = daily.withColumn("gap", F.explode(F.sequence(F.lit(0), F.lit(max(days) - 1))))
    spread = spread.withColumn("_at", F.date_add("day", F.col("gap")))
    same = F.col("_at") == F.col("at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return spread.join(at, same).drop("_at", *[f"_{k}" for k in keys])


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values per key over all days of the table (filter it for a span)."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("values"))


def trailing_distinct(bitmaps: DataFrame, keys: Sequence[str], days: Sequence[int]) -> DataFrame:
    """(keys, day, distinct_<n>d ...): distinct values of the n days that end with each day of the key."""
    met = _windows(bitmaps, keys, days)
    merged = met.groupBy(*keys, "at", "bucket").agg(*[F.bitmap_or_agg(F.when(F.col("gap") < n, F.col("bits"))).alias(f"b{n}") for n in days])
    counts = [F.sum(F.coalesce(F.bitmap_count(f"b{n}"), F.lit(0))).alias(f"distinct_{n}d") for n in days]
    return merged.groupBy(*keys, F.col("at").alias("day")).agg(*counts)


def daily_histogram(rows: DataFrame, keys: Sequence[str], day: str, value: Column, width: float | None = None) -> DataFrame:
    """(keys, day, value, n): how often each value stands on each day.

    Without ``width`` quantiles from it are exact; that suits whole numbers of a bounded range. With it values are rounded to multiples of
    ``width``: a quantile keeps its rank and is off by at most ``width / 2``.
    """
    kept = value if width is None else F.round(value / width) * width
    return rows.select(*keys, F.col(day).alias("day"), kept.cast("double").alias("value")).where("value is not null").groupBy(*keys, "day", "value").agg(F.count(F.lit(1)).alias("n"))


def quantile_of(histogram: DataFrame, keys: Sequence[str], q: float = 0.5, name: str = "quantile") -> DataFrame:
    """The quantile of each key, with linear interpolation between neighbours, from (keys, value, n)."""
    one = histogram.groupBy(*keys, "value").agg(F.sum("n").alias("n")).where("n > 0")
    ordered, all_of = Window.partitionBy(*keys).orderBy("value"), Window.partitionBy(*keys)
    upto = one.withColumn("_upto", F.sum("n").over(ordered)).withColumn("_place", (F.sum("n").over(all_of) - 1) * F.lit(float(q)))
    # The places floor and ceil of (count - 1) q, counted from 0, are held by the first values that reach beyond them.
    low, high = F.min(F.when(F.col("_upto") > F.floor("_place"), F.col("value"))), F.min(F.when(F.col("_upto") > F.ceil("_place"), F.col("value")))
    ends = upto.groupBy(*keys).agg(low.alias("_low"), high.alias("_high"), F.first("_place").alias("_p"))
    return ends.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_p") - F.floor("_p"))).alias(name))


def trailing_quantile(histogram: DataFrame, keys: Sequence[str], days: Sequence[int], q: float = 0.5) -> DataFrame:
    """(keys, day, q_<n>d ...): the quantile of the n days that end with each day of the key."""
    met = _windows(histogram, keys, days)
    out = None
    for n in days:
        part = quantile_of(met.where(F.col("gap") < n), [*keys, "at"], q, f"q_{n}d").withColumnRenamed("at", "day")
        if out is None:
            out = part
        else:
            other = part.select(*[F.col(c).alias(f"_{c}") for c in (*keys, "day")], f"q_{n}d")
            same = F.lit(True)
            for c in (*keys, "day"):
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            out = out.join(other, same, "left").drop(*[f"_{c}" for c in (*keys, "day")])
    return out
