"""Catalog tables, typed files and schema-driven projections."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_optional(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None where it does not exist yet."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_first_available(readers: Mapping[str, Callable[[], DataFrame]]) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """All sources that can be read, and (name, error) of those that cannot."""
    frames, skipped = [], []
    for name, read in readers.items():
        try:
            frames.append(read())
        except Exception as err:
            skipped.append((name, type(err).__name__))
    return frames, skipped


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column in any case, or a typed NULL where it is absent."""
    found = {c.lower(): c for c in df.columns}.get(name.lower())
    return F.col(f"`{found}`") if found else F.lit(None).cast(dtype)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def sanitise_columns(df: DataFrame) -> DataFrame:
    """Illegal characters to underscores; names equal but for case get a running number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        clean = re.sub(r"[ ,;{}()\n\t=?]", "_", c).strip("_")
        low = clean.lower()
        seen[low] = seen.get(low, -1) + 1
        names.append(clean if seen[low] == 0 else f"{clean}_{seen[low]}")
    return df.toDF(*names)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Every column lower-cased behind a prefix, for a wide join."""
    return df.withColumnsRenamed({c: prefix + c.lower() for c in df.columns})


def detect_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First candidate present in the frame; an error or None when there is none."""
    for c in candidates:
        if c in df.columns:
            return c
    if required:
        raise ValueError(f"none of {list(candidates)} in {df.columns[:30]}")
    return None


def project(df: DataFrame, columns: Mapping[str, Column | tuple[str, str] | str]) -> DataFrame:
    """One target schema from a source: a Column, a source name, or (source name, type)."""
    out = []
    for name, spec in columns.items():
        if isinstance(spec, Column):
            out.append(spec.alias(name))
        elif isinstance(spec, tuple):
            out.append(column_or_null(df, *spec).cast(spec[1]).alias(name))
        else:
            out.append(column_or_null(df, spec).cast("string").alias(name))
    return df.select(*out)


def _header_key(name: str) -> str:
    return " ".join(str(name).strip().lower().split())


def find_header(columns: Sequence[str], needles: Sequence[str], exclude: Sequence[str] = (), exact: bool = False) -> str | None:
    """Header holding (or, with ``exact``, equal to) one of the needles after whitespace is normalised."""
    for c in columns:
        key = _header_key(c)
        if any(x in key for x in exclude):
            continue
        if key in map(_header_key, needles) if exact else any(_header_key(n) in key for n in needles):
            return c
    return None


def normalise_sheet(
    df: DataFrame,
    targets: Mapping[str, Mapping[str, object]],
    *,
    source_file: str,
    source_type: str,
    modified: Column | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Any spelling of a sheet's headers to one schema, with file, type and time of the source.

    ``targets`` maps a column to {"any": [...]} substrings or {"is": [...]} whole headers, an optional
    "exclude" list, "type" and "default".
    """
    picked: dict[str, Column] = {}
    missing = []
    for name, spec in targets.items():
        exact = "is" in spec
        header = find_header(df.columns, spec["is"] if exact else spec["any"], spec.get("exclude", ()), exact)
        if header is None and name in required:
            missing.append(name)
        c = F.col(f"`{header}`") if header else F.lit(None)
        c = c.cast("string")
        kind = spec.get("type", "string")
        if kind == "double":
            c = F.coalesce(c.try_cast("double"), F.lit(0.0))
        elif kind == "date":
            c = F.try_to_timestamp(c).cast("date")
        if "default" in spec:
            c = F.coalesce(c, F.lit(spec["default"]))
        picked[name] = c
    if missing:
        raise ValueError(f"{source_file}: missing {missing}")
    return df.select(
        *[c.alias(n) for n, c in picked.items()],
        F.lit(source_file).alias("source_file"),
        F.lit(source_type).alias("source_type"),
        (modified if modified is not None else F.lit(None).cast("timestamp")).alias("source_mtime"),
    )


def union_tabs(tabs: Mapping[str, DataFrame], numeric: Sequence[str]) -> DataFrame:
    """Tabs stacked with their name; numeric columns coerced, junk to 0."""
    out = None
    for name, df in tabs.items():
        df = df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in numeric})
        df = df.withColumn("_tab", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def melt(df: DataFrame, ids: Sequence[str], drop: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide category columns to rows; empty cells are left out."""
    cats = [c for c in df.columns if c not in {*ids, *drop}]
    wide = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in cats])
    return wide.unpivot(list(ids), cats, name, value).where(F.col(value).isNotNull())


def valid_mapping(
    df: DataFrame, keys: Sequence[str], value: str, status: str | None = None, ok: str = "✅", bad: str = "⚠"
) -> DataFrame:
    """Mapping rows that are approved and filled; trimmed keys, a blank key standing for any value."""
    d = df.where(F.trim(F.coalesce(F.col(value), F.lit(""))) != "").where(~F.col(value).startswith(bad))
    if status:
        d = d.where(F.coalesce(F.col(status).startswith(ok), F.lit(False)))
    return d.select(*[F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(k) for k in keys], F.trim(value).alias(value))


def read_typed_csv(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Delimited file read as text and cast per column; a cell that does not cast is NULL."""
    text = spark.read.option("header", True).csv(path, schema=", ".join(f"`{c}` string" for c in columns))
    return text.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()])


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Inline rows as a local relation, whose exact size the planner knows when it picks a join."""
    types = StructType.fromDDL(schema)
    columns = zip(*rows) if rows else [[] for _ in types]
    arrow = pa.table({f.name: pa.array(list(c), to_arrow_type(f.dataType)) for f, c in zip(types, columns)})
    return spark.createDataFrame(arrow, types)
