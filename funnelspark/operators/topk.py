"""Report ordering and top-k lists with stated ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_counts(df: DataFrame, by: Sequence[str], n: int, count: str = "n") -> DataFrame:
    """The ``n`` most frequent groups; equal counts in order of the group columns."""
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    return agg.orderBy(F.col(count).desc(), *[F.col(c).asc_nulls_last() for c in by]).limit(n)


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the greatest ``by``: a per-task top-k merged on the driver side of the plan, no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie]).limit(k)


def report_order(columns: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    """Sort columns of a report, NULLs last in both directions."""
    return [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in columns]


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """A capped, ordered sample of rows for a report."""
    return df.orderBy(*report_order(order)).limit(n)
