"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelspark.plans import (  # noqa: F401  (importing registers the queries)
    catalog_aggregates,
    catalog_builders,
    catalog_functions,
    catalog_jobs,
    catalog_joins,
    catalog_measures,
    catalog_models,
    catalog_rules,
    catalog_sources,
)
from funnelspark.plans.registry import REGISTRY
from funnelspark.plans.shapes import CTES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in sorted(REGISTRY.items())}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, q in sorted(REGISTRY.items()):
        sql = q.sql(CTES)
        if sql is not None:
            out[name] = sql
    return out
