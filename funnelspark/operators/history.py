"""Version history from snapshots (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.functions.text import row_hash
from funnelspark.operators.dedupe import best


def drop_nested(df: DataFrame) -> DataFrame:
    """Without struct, array and map columns."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    return df.drop(*nested)


def changed(df: DataFrame, keys: Sequence[str], order: str, hash_col: str) -> DataFrame:
    """Rows whose hash differs from the previous row of the key, and first rows."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.lag(hash_col).over(w)
    return (
        df.withColumn("_changed", prev.isNull() | (prev != F.col(hash_col))).where("_changed").drop("_changed")
    )


def version_number(keys: Sequence[str], order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order))


def valid_to(keys: Sequence[str], start: str) -> Column:
    """The day before the next version starts; NULL for the current one."""
    return F.date_sub(F.lead(start).over(Window.partitionBy(*keys).orderBy(start)), 1)


def scd2(
    df: DataFrame,
    key: str,
    snapshot: str,
    modified: str | None = None,
    tie: Sequence[str] = (),
    compat_hash: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(history, current) of a key over dated snapshots.

    One row per key and snapshot is kept first, so a key has at most one row per snapshot date in the
    windows that follow: their partitions are bounded by the calendar, not by the data. A key that
    disappears keeps its last version open; a value that returns starts a new version.
    """
    flat = drop_nested(df)
    order = [F.col(modified).desc_nulls_last()] if modified else []
    order += [F.col(c).desc_nulls_last() for c in tie]
    if not order:
        order = [F.col(key).desc()]
    one = best(flat, [snapshot, key], order)
    hashed = [c for c in flat.columns if c not in {snapshot, key, modified}]
    one = one.withColumn("row_hash", row_hash(hashed, compat=compat_hash))
    versions = (
        changed(one, [key], snapshot, "row_hash")
        .withColumn("version", version_number([key], snapshot))
        .withColumnRenamed(snapshot, "valid_from")
        .withColumn("valid_to", valid_to([key], "valid_from"))
    )
    return versions, versions.where(F.col("valid_to").isNull())
