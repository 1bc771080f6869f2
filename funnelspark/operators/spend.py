"""Ad-spend rollups: ratios are recomputed from sums, never averaged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("cost", "impressions", "clicks", "conversions", "conversions_value")


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def rollup_spend(daily: DataFrame, period: Column, name: str, keys: Sequence[str]) -> DataFrame:
    """Metrics summed per period and key with ctr, avg_cpc and roas; zero denominators give 0."""
    agg = daily.groupBy(period.alias(name), *keys).agg(*[F.sum(m).alias(m) for m in METRICS])
    return (
        agg.withColumn("ctr", _ratio("clicks", "impressions"))
        .withColumn("avg_cpc", _ratio("cost", "clicks"))
        .withColumn("roas", _ratio("conversions_value", "cost"))
    )
