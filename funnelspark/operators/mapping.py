"""Governed dimension maps with unmapped values kept and labelled.

Map sides carry no broadcast hint: Spark broadcasts them only while their measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks it at run time; larger maps join by shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.text import collapse_spaces, text_or_empty
from funnelspark.operators.dedupe import best

UNMAPPED = "UNMAPPED"


def _one_per_key(mapping: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key, so that the join cannot fan out; the least value wins."""
    return best(mapping, keys, [F.col(value).asc_nulls_last()]).select(*keys, value)


def map_values(
    df: DataFrame, mapping: DataFrame, key: str, map_key: str, map_value: str, out: str, blank: object = None
) -> DataFrame:
    """Single-key map: blank input gives ``blank``, a miss gives the unmapped label."""
    m = _one_per_key(mapping, [map_key], map_value).select(
        F.col(map_key).alias("_mk"), F.col(map_value).alias("_mv")
    )
    joined = df.join(m, F.col(key) == F.col("_mk"), "left")
    value = (
        F.when(F.col(key).isNull() | (F.trim(text_or_empty(F.col(key))) == ""), F.lit(blank))
        .when(F.col("_mv").isNull(), F.lit(UNMAPPED))
        .otherwise(F.col("_mv"))
    )
    return joined.withColumn(out, value).drop("_mk", "_mv")


def map_with_wildcard(
    df: DataFrame,
    mapping: DataFrame,
    keys: Sequence[str],
    map_keys: Sequence[str],
    map_value: str,
    out: str,
    missing_key: str = "NULL",
) -> DataFrame:
    """Exact match on all keys, else on the first key against rows whose other keys are blank."""
    first, rest = map_keys[0], map_keys[1:]
    m = mapping.select(*[F.trim(text_or_empty(F.col(k))).alias(k) for k in map_keys], map_value)
    blank_rest = F.lit(True)
    for k in rest:
        blank_rest = blank_rest & (F.col(k) == "")
    exact = _one_per_key(m.where(~blank_rest), map_keys, map_value)
    exact = exact.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(map_keys)], F.col(map_value).alias("_exact"))
    wild = _one_per_key(m.where(blank_rest), [first], map_value).select(
        F.col(first).alias("_w0"), F.col(map_value).alias("_wild")
    )
    lead = F.coalesce(F.trim(F.col(keys[0]).cast("string")), F.lit(missing_key))
    cond = lead == F.col("_e0")
    for i, k in enumerate(keys[1:], start=1):
        cond = cond & (F.trim(text_or_empty(F.col(k))) == F.col(f"_e{i}"))
    joined = df.join(exact, cond, "left").join(wild, lead == F.col("_w0"), "left")
    return joined.withColumn(out, F.coalesce("_exact", "_wild", F.lit(UNMAPPED))).select(*df.columns, out)


def map_pair(
    df: DataFrame, mapping: DataFrame, keys: tuple[str, str], map_keys: tuple[str, str], map_value: str, out: str
) -> DataFrame:
    """Two-column map in which a blank second value is a key of its own; a miss stays NULL."""
    m = mapping.select(
        F.col(map_keys[0]).alias("_a"), F.trim(text_or_empty(F.col(map_keys[1]))).alias("_b"), F.col(map_value).alias("_v")
    )
    m = _one_per_key(m, ["_a", "_b"], "_v")
    cond = (F.col(keys[0]) == F.col("_a")) & (text_or_empty(F.col(keys[1])) == F.col("_b"))
    return df.join(m, cond, "left").withColumn(out, F.col("_v")).drop("_a", "_b", "_v")


def canonical_names(df: DataFrame, column: str, names: DataFrame, raw: str, canonical: str) -> DataFrame:
    """Replace a name by its canonical form, compared without case and repeated blanks.

    Blank stays NULL, a name not in the list becomes ``Unknown``.
    """
    m = names.select(collapse_spaces(F.col(raw)).alias("_nk"), F.col(canonical).alias("_canon"))
    m = _one_per_key(m, ["_nk"], "_canon")
    joined = df.join(m, collapse_spaces(F.col(column)) == F.col("_nk"), "left")
    value = (
        F.when(F.trim(text_or_empty(F.col(column))) == "", F.lit(None).cast("string"))
        .when(F.col("_canon").isNotNull(), F.col("_canon"))
        .otherwise(F.lit("Unknown"))
    )
    return joined.withColumn(column, value).drop("_nk", "_canon")


def remap_ids(df: DataFrame, crosswalk: DataFrame, column: str, canonical: str) -> DataFrame:
    """Replace an id by its canonical id where the crosswalk (one row per id) knows it."""
    m = crosswalk.select(F.col(column).alias("_id"), F.col(canonical).alias("_to"))
    return (
        df.join(m, F.col(column) == F.col("_id"), "left")
        .withColumn(column, F.coalesce("_to", column))
        .drop("_id", "_to")
    )


def missing_members(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """Distinct non-NULL fact values that the dimension lacks."""
    values = fact.where(F.col(fact_col).isNotNull()).select(F.col(fact_col).alias("value")).distinct()
    return values.join(dim.select(F.col(dim_col).alias("value")), "value", "left_anti")


def unmapped_audit(
    df: DataFrame,
    unmapped: Column,
    keys: Sequence[str],
    day: str,
    sample: str,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Unmapped rows per key: count, first and last day, a sample text, and whether the key is new.

    Keys compare NULL-safe, so a row without an account is reported too.
    """
    agg = (
        df.where(unmapped)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(day).alias("first_seen"),
            F.max(day).alias("last_seen"),
            F.min(sample).alias("sample"),
        )
    )
    if seen is None:
        return agg.withColumn("is_new", F.lit(True))
    log = seen.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).distinct().withColumn("_hit", F.lit(True))
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_s{i}"))
    return agg.join(log, cond, "left").select(*agg.columns, F.col("_hit").isNull().alias("is_new"))


def cast_failures(df: DataFrame, column: str, dtype: str) -> DataFrame:
    """Rows whose filled text does not cast: the quarantine of a typed load."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast(dtype).isNull())
