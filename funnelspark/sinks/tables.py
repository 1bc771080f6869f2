"""Overwrite, window replace, keyed merge and append.

Partitioned tables are maintained by dynamic partition overwrite: only the partitions that change are
read and rewritten, so a weekly run over years of history touches weeks, not the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.operators.dedupe import newest_pull
from funnelspark.session import materialise, remove


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """The session's partition overwrite mode for the span of one write.

    As a write option it would be stored with the table and decide its later writes too.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partition value brought together, values that are too large split again by AQE."""
    return df.hint("rebalance", *columns)


def overwrite(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Replace the whole table, schema included."""
    if partition_by:
        df = _by_partition(df, partition_by)
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    with _overwrite_mode(df.sparkSession, "static"):
        w.saveAsTable(table)


def append(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append, creating the table on the first run."""
    w = df.write.mode("append").format("parquet")
    if path and not df.sparkSession.catalog.tableExists(table):
        w = w.option("path", path)
    w.saveAsTable(table)


def _write_partitions(df: DataFrame, table: str, partition: str) -> None:
    """Replace exactly the partitions present in ``df``."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    with _overwrite_mode(spark, "dynamic"):
        _by_partition(df.select(*cols), [partition]).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def _add_columns(df: DataFrame, table: str) -> None:
    """Columns of ``df`` that the table lacks are added to its schema; rows already there read NULL."""
    spark = df.sparkSession
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the table's columns in its order, missing ones NULL."""
    target = df.sparkSession.table(table)
    return target.limit(0).unionByName(df, allowMissingColumns=True).select(*target.columns)


def replace_partition(df: DataFrame, table: str, partition: str, path: str | None = None) -> None:
    """Replace one week (or the weeks in ``df``). New columns are added to the table, older weeks keep their files."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        overwrite(df, table, [partition], path)
        return
    _add_columns(df, table)
    _write_partitions(_aligned(df, table), table, partition)


def swap(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Write to a side table, then rename: the old version is dropped last, so one whole version exists at any time.

    A run that broke off between the two renames is mended by the next one, which first puts the old version back.
    ``path`` names the folder family; every version gets a folder of its own, since the old one may be read
    while the new one is written; the folder of the version before is removed at the end.
    """
    spark = df.sparkSession
    side, old = f"{table}__next", f"{table}__old"
    if spark.catalog.tableExists(old):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {side}")
    overwrite(df, side, partition_by, f"{path}__{uuid.uuid4().hex[:12]}" if path else None)
    before = None
    if spark.catalog.tableExists(table):
        if path:
            before = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {side} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if before and before["data_type"].rstrip("/").rpartition("/")[2].startswith(path.rstrip("/").rpartition("/")[2]):
        remove(spark, before["data_type"])
    spark.catalog.refreshTable(table)


def _drop_partitions(spark: SparkSession, table: str, partition: str, values: Sequence[object]) -> None:
    for v in values:
        text = str(v).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{partition}` = '{text}')")


def _partition_values(df: DataFrame, partition: str, cond: Column | None = None) -> list[object]:
    """Distinct partition values, NULL (last) included: a metadata-sized list (weeks or days)."""
    d = df if cond is None else df.where(cond)
    return sorted((r[0] for r in d.select(partition).distinct().toLocalIterator()), key=lambda v: (v is None, v))


def _touched(df: DataFrame, partition: str, values: Sequence[object]) -> DataFrame:
    """Rows of the given partition values, NULL being one of them."""
    known = [v for v in values if v is not None]
    cond = F.col(partition).isin(known) if known else F.lit(False)
    return df.where(cond | F.col(partition).isNull() if None in values else cond)


def replace_range(df: DataFrame, table: str, partition: str, low: object, high: object, path: str | None = None) -> None:
    """Delete a date range and load the new rows of that range; the table is partitioned by the date.

    New rows replace their partitions in one commit; partitions of the range without new rows are dropped.
    """
    spark = df.sparkSession
    inside = F.col(partition).between(F.lit(low), F.lit(high))
    new = df.where(inside)
    if not spark.catalog.tableExists(table):
        overwrite(new, table, [partition], path)
        return
    new = materialise(new, "replace-range")
    old_values = _partition_values(spark.table(table), partition, inside)
    new_values = set(_partition_values(new, partition))
    _add_columns(new, table)
    _write_partitions(_aligned(new, table), table, partition)
    _drop_partitions(spark, table, partition, [v for v in old_values if v not in new_values])
    spark.catalog.refreshTable(table)


def merge(
    updates: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    floor: object | None = None,
    replace_window: bool = False,
    path: str | None = None,
) -> None:
    """Keyed merge with null-safe keys: update what matches, insert the rest, drop updates below ``floor``.

    Vanished keys stay unless ``replace_window`` is set, which replaces the touched partitions outright.
    Only the partitions present in ``updates`` (the NULL partition included) are read and rewritten. ``partition`` must be a merge key.
    Columns new to the table are added, columns missing from ``updates`` become NULL in its rows. Two updates of one key are an error.
    ``updates`` is evaluated once.
    """
    if partition not in keys:
        raise ValueError("the partition column must be one of the keys")
    spark = updates.sparkSession
    if floor is not None:
        updates = updates.where(F.col(partition) >= F.lit(floor))
    updates = materialise(updates, "merge")
    if not replace_window:
        twice = updates.groupBy(*keys).count().where("count > 1").first()
        if twice is not None:
            raise ValueError(f"several updates for one key, such as {twice.asDict()}")
    if not spark.catalog.tableExists(table):
        overwrite(updates, table, [partition], path)
        return
    _add_columns(updates, table)
    updates = _aligned(updates, table)
    if replace_window:
        _write_partitions(updates, table, partition)
        return
    kept = _touched(spark.table(table), partition, _partition_values(updates, partition))
    ids = updates.select(*[F.col(k).alias(f"_u{i}") for i, k in enumerate(keys)])
    cond = None
    for i, k in enumerate(keys):
        part = F.col(k).eqNullSafe(F.col(f"_u{i}"))
        cond = part if cond is None else cond & part
    _write_partitions(kept.join(ids, cond, "left_anti").unionByName(updates), table, partition)


def upsert_newest(new: DataFrame, table: str, keys: Sequence[str], pulled_at: str, partition: str, path: str | None = None) -> None:
    """History upsert: of all pulls of a key the newest wins; touched partitions only (the NULL partition included).

    Columns new to the table are added, missing ones become NULL; ``new`` is evaluated once.

    ``partition`` must be one of the keys: a key that changed its partition would leave its old row behind.
    """
    if partition not in keys:
        raise ValueError("the partition column must be one of the keys")
    spark = new.sparkSession
    if not spark.catalog.tableExists(table):
        overwrite(newest_pull(new.limit(0), new, keys, pulled_at), table, [partition], path)
        return
    new = materialise(new, "upsert")
    _add_columns(new, table)
    old = _touched(spark.table(table), partition, _partition_values(new, partition))
    _write_partitions(newest_pull(old, _aligned(new, table), keys, pulled_at), table, partition)


def log_run(spark: SparkSession, table: str, row: Mapping[str, object], schema: str, path: str | None = None) -> None:
    """Append one typed status row."""
    append(spark.createDataFrame([tuple(row.values())], schema), table, path)


def typed_views(df: DataFrame, column: str, views: Mapping[str, str]) -> None:
    """One temporary view per value of ``column``."""
    for view, value in views.items():
        df.where(F.col(column) == value).createOrReplaceTempView(view)


def shared(df: DataFrame, by: str) -> DataFrame:
    """Bring rows of a write key together and persist, for a frame read by several writes; unpersist when done."""
    return _by_partition(df, [by]).persist()


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
