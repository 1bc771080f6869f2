"""Incremental JSON ingest and latest-wins arrival."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from funnelspark.operators.dedupe import latest
from funnelspark.session import materialise
from funnelspark.sinks.tables import upsert_newest
from funnelspark.sources.json_pages import parse_values
from funnelspark.sources.json_values import split_values, text_lines


def json_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of new JSON files as a stream, with their file and split; the checkpoint remembers what was read."""
    source = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
    return text_lines(source.text(path))


def json_batch(lines: DataFrame, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows with ``path``, rejects (path, text)) of the lines of one batch. A batch holds whole files, so no value is cut by its end."""
    parsed = materialise(parse_values(split_values(lines), schema), "json-batch")
    rows = parsed.where("bad is null").select("path", "value.*")
    return rows, parsed.where("bad is not null").select("path", F.col("bad").alias("text"))


def ingest_json(
    lines: DataFrame,
    schema: StructType | str,
    rows: str,
    rejects: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    redeliver_first: bool = False,
) -> StreamingQuery:
    """Read what has arrived: every value of every file as a row of ``rows``, what does not parse as a row of ``rejects``.

    Both folders are partitioned by ``batch_id`` and a batch overwrites its own partition, so one that is delivered again after a failure
    (``redeliver_first`` forces that) leaves both as they were. A batch without rejects clears its partition of them.
    ``shape`` turns the rows of a batch into those of the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = json_batch(batch, schema)
        for frame, path in ((shape(good) if shape else good, rows), (bad, rejects)):
            frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    def deliver(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if redeliver_first and batch_id == 0:
            write(batch, batch_id)

    return lines.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_available(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    ingested_at: str,
    partition: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    tie: Sequence[str] = (),
    path: str | None = None,
) -> StreamingQuery:
    """Read what has arrived and upsert it: of all copies of a key the newest ``ingested_at`` wins.

    Late copies need no watermark: an older one never replaces a newer one. A batch that is replayed after a
    failure gives the same table, so the sink is idempotent.
    """

    caller = stream.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        rows = shape(batch) if shape else batch
        one = latest(rows, keys, [ingested_at], tie)
        upsert_newest(one, table, keys, ingested_at, partition, path)
        # a batch runs in a session of its own, whose refresh the caller's file listing does not see
        caller.catalog.refreshTable(table)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new rows to a parquet folder (exactly once by the sink's log)."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_view(log: DataFrame, keys: Sequence[str], ingested_at: str, tie: Sequence[str] = ()) -> DataFrame:
    """Current rows of an append-only arrival log."""
    return latest(log, keys, [ingested_at], tie)


def late_rows(log: DataFrame, event_day: str, ingested_at: str, days: int) -> DataFrame:
    """Arrivals more than ``days`` after their event day."""
    return log.where(F.datediff(F.col(ingested_at).cast("date"), F.col(event_day)) > days)
