"""Named queries over a folder of parquet tables, each with its comparison SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import SESSION_CONF

TYPES = {"i": ("bigint", "BIGINT"), "s": ("string", "VARCHAR"), "f": ("double", "DOUBLE")}
RUNTIME_CONF = {k: v for k, v in SESSION_CONF.items() if k.startswith("spark.sql.")}


class Tables:
    """Lazy access to the tables of one folder: ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        for key, value in RUNTIME_CONF.items():
            spark.conf.set(key, value)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    columns: tuple[tuple[str, str], ...]
    body: str | None
    uses: tuple[str, ...]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Tables(spark, folder))
        out = []
        for name, kind in self.columns:
            c = F.col(f"`{name}`").cast(TYPES[kind][0])
            if kind == "f":
                # eight digits first: the last bits of a double sum depend on the order of addition
                c = F.round(F.round(c, 8), 4) + F.lit(0.0)
            out.append(c.alias(name))
        return df.select(*out)

    def sql(self, ctes: dict[str, tuple[str, tuple[str, ...]]]) -> str | None:
        if self.body is None:
            return None
        out = []
        for name, kind in self.columns:
            c = f'CAST("{name}" AS {TYPES[kind][1]})'
            if kind == "f":
                c = f"CAST(ROUND(CAST({c} AS DECIMAL(30, 8)), 4) AS DOUBLE) + 0.0"
            out.append(f'{c} AS "{name}"')
        order: list[str] = []

        def need(cte: str) -> None:
            for dep in ctes[cte][1]:
                need(dep)
            if cte not in order:
                order.append(cte)

        for cte in self.uses:
            need(cte)
        head = "WITH " + ",\n".join(f"{c} AS ({ctes[c][0]})" for c in order) + "\n" if order else ""
        return f"{head}SELECT {', '.join(out)} FROM ({self.body}) AS q"


REGISTRY: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None, uses: Sequence[str] = ()) -> Callable:
    """Register a builder; ``columns`` lists ``name:type`` with i (whole), s (text), f (double, 4 digits)."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        cols = tuple(tuple(c.rsplit(":", 1)) for c in columns.split())
        REGISTRY[name] = Query(name, fn, cols, sql, tuple(uses))
        return fn

    return wrap
