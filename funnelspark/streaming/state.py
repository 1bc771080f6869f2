"""Keyed state that each arriving batch brings up to date: version history and latest rows without re-reading what came before.

A store is a folder of the shared file system. ``state/upto=<batch>`` holds one row per key after that batch, ``closed/batch_id=<batch>`` what the
batch settled for good, ``late/batch_id=<batch>`` what came too late. A batch reads the state before it and its own rows only, and
overwrites nothing but its own partitions, so one that is delivered again gives the same. The state before the last is removed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from funnelspark.functions.text import row_hash
from funnelspark.operators.dedupe import best, latest
from funnelspark.operators.history import drop_nested
from funnelspark.session import materialise, remove


def batches(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the ``<name>=<number>`` folders that were written to the end, in order."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    found = [re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()) for s in files.listStatus(where)]
    done = [int(m[1]) for m in found if m]
    return sorted(b for b in done if files.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}={b}/_SUCCESS")))


def state_before(spark: SparkSession, store: str, batch_id: int) -> DataFrame | None:
    """One row per key as of the batch before, or None."""
    earlier = [b for b in batches(spark, f"{store}/state", "upto") if b < batch_id]
    return spark.read.parquet(f"{store}/state/upto={earlier[-1]}") if earlier else None


def _store(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def _forget(spark: SparkSession, store: str, batch_id: int) -> None:
    for b in [b for b in batches(spark, f"{store}/state", "upto") if b < batch_id][:-1]:
        remove(spark, f"{store}/state/upto={b}")


def next_versions(
    state: DataFrame | None, rows: DataFrame, key: str, snapshot: str, modified: str | None = None, tie: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(closed versions, new state, late rows) of the rows of one or more snapshots on top of the state.

    The state holds each key's open version: its columns, ``row_hash``, ``version``, ``valid_from``, and ``seen``, the key's last snapshot. A key's
    rows must come in order of their snapshots; a row not after ``seen`` changes nothing and is handed back as late.
    """
    flat = drop_nested(rows)
    order = [F.col(modified).desc_nulls_last()] if modified else []
    order += [F.col(c).desc_nulls_last() for c in tie] or ([] if modified else [F.col(key).desc()])
    hashed = [c for c in flat.columns if c not in {snapshot, key, modified}]
    one = best(flat, [snapshot, key], order).withColumn("row_hash", row_hash(hashed))
    new = one.withColumnRenamed(snapshot, "valid_from").withColumns({"version": F.lit(None).cast("int"), "seen": F.col("valid_from")})
    both = new if state is None else state.unionByName(new)
    # Every window is a key: its open version and its rows of this batch.
    keyed = Window.partitionBy(key)
    in_order = keyed.orderBy(F.col("version").asc_nulls_last(), "valid_from")
    known = F.max(F.when(F.col("version").isNotNull(), F.col("seen"))).over(keyed)
    both = both.withColumn("_late", F.col("version").isNull() & F.coalesce(F.col("valid_from") <= known, F.lit(False)))
    both = materialise(both, "state-rows")
    late = both.where("_late").withColumnRenamed("valid_from", snapshot).select(*one.columns).drop("row_hash")
    kept = both.where("not _late")
    before = F.lag("row_hash").over(in_order)
    kept = kept.withColumn("seen", F.max("seen").over(keyed)).withColumn("_new", F.col("version").isNull() & (before.isNull() | (before != F.col("row_hash"))))
    kept = kept.where("version is not null or _new")
    number = F.coalesce(F.max("version").over(keyed), F.lit(0)) + F.sum(F.col("_new").cast("int")).over(in_order)
    kept = kept.withColumn("_version", number.cast("int")).withColumn("valid_to", F.date_sub(F.lead("valid_from").over(in_order), 1))
    kept = kept.withColumn("version", F.col("_version"))
    columns = [c for c in new.columns if c != "seen"]
    return kept.where("valid_to is not null").select(*columns, "valid_to"), kept.where("valid_to is null").select(*columns, "seen"), late


def apply_snapshots(rows: DataFrame, batch_id: int, store: str, key: str, snapshot: str, modified: str | None = None, tie: Sequence[str] = ()) -> None:
    """Bring the version history in ``store`` up to date with a batch of snapshot rows."""
    spark = rows.sparkSession
    closed, state, late = next_versions(state_before(spark, store, batch_id), rows, key, snapshot, modified, tie)
    _store(closed, f"{store}/closed/batch_id={batch_id}")
    _store(late, f"{store}/late/batch_id={batch_id}")
    # The state comes last: a batch without it is taken up again from the state before.
    _store(state, f"{store}/state/upto={batch_id}")
    _forget(spark, store, batch_id)


def apply_latest(rows: DataFrame, batch_id: int, store: str, keys: Sequence[str], ingested_at: str, tie: Sequence[str] = ()) -> None:
    """Keep the newest row of each key: of the state and the batch, whichever comes first."""
    spark = rows.sparkSession
    state = state_before(spark, store, batch_id)
    one = latest(rows, keys, [ingested_at], tie)
    both = one if state is None else latest(state.unionByName(one, allowMissingColumns=True), keys, [ingested_at], tie)
    _store(both, f"{store}/state/upto={batch_id}")
    _forget(spark, store, batch_id)


def on_arrival(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``apply(batch, batch_id)`` on all that has arrived."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_rows(spark: SparkSession, store: str) -> DataFrame:
    """One row per key, as of the last batch."""
    return spark.read.parquet(f"{store}/state/upto={batches(spark, f'{store}/state', 'upto')[-1]}")


def version_history(spark: SparkSession, store: str) -> DataFrame:
    """All versions: those closed in any batch up to the state, and the open ones."""
    last = batches(spark, f"{store}/state", "upto")[-1]
    closed = spark.read.option("basePath", f"{store}/closed").parquet(*(f"{store}/closed/batch_id={b}" for b in batches(spark, f"{store}/closed", "batch_id") if b <= last))
    return closed.drop("batch_id").unionByName(current_rows(spark, store).drop("seen"), allowMissingColumns=True)
