"""Date, month and site dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions.dates import date_parts
from funnelspark.sources.tables import literal_table


def date_spine(spark: SparkSession, start: object, end: object, name: str = "date_key") -> DataFrame:
    """One row per day, bounded by the calendar."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(name)
    )


def dim_date(spark: SparkSession, start: object, end: object) -> DataFrame:
    d = date_spine(spark, start, end)
    return d.select("date_key", *[c.alias(n) for n, c in date_parts(F.col("date_key")).items()])


def dim_month(spark: SparkSession, start: object, end: object) -> DataFrame:
    """yyyy-MM, short label and running number per month."""
    return spark.range(1).select(
        F.posexplode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("i", "d")
    ).select(F.date_format("d", "yyyy-MM").alias("month"), F.date_format("d", "MMM").alias("month_label"), (F.col("i") + 1).alias("month_sort"))


def dim_members(spark: SparkSession, members: Sequence[tuple], schema: str, catch_all: Sequence[tuple] = ()) -> DataFrame:
    """Literal dimension with its catch-all members, so that unmatched facts stay selectable."""
    return literal_table(spark, [*members, *catch_all], schema)
