"""Time-windowed matching without pairing all events of a key.

Both operators replace an equality-plus-range join. That join forms every pair of a key inside the
window, which is quadratic for a key with many events; here both sides are cut to one row per key and time, every
row looks at one neighbour, and the answers are joined back, so the work is linear whatever the key
distribution and no window group grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Time units of one window group; with one row per key and unit on either side a group has at most twice as many rows.
_SPAN = 3600


def null_spread(df: DataFrame, slots: int = 4096) -> Column:
    """Repeatable slot for rows without a key, so they do not gather in one partition."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, _PLAIN)]
    return F.pmod(F.xxhash64(*plain), F.lit(slots))


def first_lookup(starts: DataFrame, events: DataFrame, *, length: int, include_start: bool = False) -> DataFrame:
    """First event at or after every (``_key``, ``_t``) of ``starts``, at most ``length`` later: these two and ``_event``.

    ``events`` has ``_key``, ``_t`` and a struct ``_event`` that begins with ``t`` and ``id``. Both sides are cut to one row
    per key and time before they meet, combined in each task: of events at one time only the least can be an answer, and all
    starts at one time have the same answer. A window group is a key's span of ``_SPAN`` units, so it has at most
    ``2 * _SPAN + 1`` rows however many records crowd into it; the first event of later spans reaches a group as one row.
    """
    starts = starts.select("_key", "_t").distinct()
    hits = events.groupBy("_key", "_t").agg(F.min("_event").alias("_event"))
    span = F.floor(F.col("_t") / _SPAN).cast("long")
    event_type = hits.schema["_event"].dataType
    probes = starts.select("_key", "_t", span.alias("_bin"), F.lit(0).alias("_side"), F.lit(None).cast(event_type).alias("_event"))
    hits = hits.select("_key", "_t", span.alias("_bin"), F.lit(1).alias("_side"), "_event")
    both = probes.unionByName(hits)
    later = Window.partitionBy("_key").orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy("_key", "_bin")
        .agg(F.min("_event").alias("_first"))
        .withColumn("_event", F.last("_first", ignorenulls=True).over(later))
        .where(F.col("_event").isNotNull())
        .select("_key", F.lit(2**63 - 1).cast("long").alias("_t"), "_bin", F.lit(1).alias("_side"), "_event")
    )
    side_order = F.col("_side").desc() if include_start else F.col("_side").asc()
    backwards = (
        Window.partitionBy("_key", "_bin")
        .orderBy(F.col("_t").desc(), side_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.unionByName(carried)
        .withColumn("_event", F.last("_event", ignorenulls=True).over(backwards))
        .where((F.col("_side") == 0) & (F.col("_event.t") - F.col("_t") <= length))
        .select("_key", "_t", "_event")
    )


def first_in_window(
    base: DataFrame,
    events: DataFrame,
    *,
    base_key: str,
    base_time: Column,
    event_key: str,
    event_time: Column,
    event_id: str,
    carry: Sequence[str] = (),
    after: int = 0,
    until: int,
    include_start: bool = False,
    match: str = "match",
) -> DataFrame:
    """Earliest event of the same key with time in ``(base + after, base + until]``, one row per base row.

    Times are whole numbers in one unit. ``include_start`` closes the lower end. The result is ``base``
    plus a struct column (``t``, ``id`` and the ``carry`` columns), NULL where nothing falls inside.
    Equal times go to the least ``event_id``.

    Answers are found for distinct keys and times (``first_lookup``) and joined back by both, so a key that holds a third of
    all rows inside one hour is spread over the times of that hour, and rows of one single time are split by AQE's skew join.
    Base rows are sent once, or not at all where the answers are small enough to be broadcast. Rows without a key are spread.
    """
    hits = events.where(F.col(event_key).isNotNull() & event_time.isNotNull()).select(
        F.col(event_key).alias("_key"),
        event_time.cast("long").alias("_t"),
        F.struct(event_time.cast("long").alias("t"), F.col(event_id).alias("id"), *carry).alias("_event"),
    )
    start = (base_time + F.lit(after)).cast("long")
    usable = F.col(base_key).isNotNull() & start.isNotNull()
    starts = base.where(usable).select(F.col(base_key).alias("_key"), start.alias("_t"))
    found = first_lookup(starts, hits, length=until - after, include_start=include_start)
    found = found.select(
        F.col("_key").alias("_found_key"), F.col("_t").alias("_found_t"), F.lit(0).cast("long").alias("_found_slot"), F.col("_event").alias(match)
    )
    slot = F.when(usable, F.lit(0)).otherwise(null_spread(base)).cast("long")
    held = base.select(*[F.col(c) for c in base.columns if c != match], start.alias("_start"), slot.alias("_slot"))
    cond = (F.col(base_key) == F.col("_found_key")) & (F.col("_start") == F.col("_found_t")) & (F.col("_slot") == F.col("_found_slot"))
    return held.join(found, cond, "left").drop("_found_key", "_found_t", "_found_slot", "_start", "_slot")


def nearest_lookup(
    base: DataFrame,
    cands: DataFrame,
    *,
    base_key: str,
    base_day: Column,
    cand_key: str,
    cand_day: Column,
    rank: Sequence[Column],
    carry: Sequence[str],
    match: str = "match",
) -> DataFrame:
    """Nearest candidate of every (key, day) that occurs in ``base``: columns ``_key``, ``_day`` and ``match``.

    Candidates are first cut to the best one per key and day and base rows to distinct key and day, so a
    key has at most a calendar's worth of rows in the window however many records share it.
    """
    keyed = cands.where(F.col(cand_key).isNotNull()).select(
        F.col(cand_key).alias("_key"),
        cand_day.cast("date").alias("_day"),
        F.struct(F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]).alias("rank"), F.struct(*carry).alias("c")).alias(
            "_cand"
        ),
    )
    w = Window.partitionBy("_key", "_day").orderBy(F.col("_cand.rank").asc())
    daily = keyed.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    cand_type = daily.schema["_cand"].dataType
    probes = (
        base.where(F.col(base_key).isNotNull())
        .select(F.col(base_key).alias("_key"), base_day.cast("date").alias("_day"))
        .distinct()
    )
    both = daily.select(
        "_key", "_day", F.lit(0).alias("_side"), F.struct("_day", "_cand").alias("_hit")
    ).unionByName(
        probes.select(
            "_key",
            "_day",
            F.lit(1).alias("_side"),
            F.lit(None).cast(T.StructType([T.StructField("_day", T.DateType()), T.StructField("_cand", cand_type)])).alias(
                "_hit"
            ),
        )
    )
    dated = F.when(F.col("_day").isNotNull(), F.col("_hit"))
    up = Window.partitionBy("_key").orderBy(F.col("_day").asc_nulls_first(), F.col("_side").asc())
    down = Window.partitionBy("_key").orderBy(F.col("_day").desc_nulls_last(), F.col("_side").asc())
    whole = Window.partitionBy("_key")
    placed = both.select(
        "_key",
        "_day",
        "_side",
        F.last(dated, ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, 0)).alias("_before"),
        F.last(dated, ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("_after"),
        F.min(F.when(F.col("_day").isNull(), F.col("_hit._cand"))).over(whole).alias("_undated"),
        F.min(F.col("_hit._cand")).over(whole).alias("_any"),
    ).where("_side = 1")
    back = F.datediff(F.col("_day"), F.col("_before._day"))
    ahead = F.datediff(F.col("_after._day"), F.col("_day"))
    take_before = back.isNotNull() & (
        ahead.isNull() | (back < ahead) | ((back == ahead) & (F.col("_before._cand.rank") <= F.col("_after._cand.rank")))
    )
    pick = (
        F.when(F.col("_day").isNull(), F.col("_any"))
        .when(take_before, F.col("_before._cand"))
        .when(ahead.isNotNull(), F.col("_after._cand"))
        .otherwise(F.col("_undated"))
    )
    gap = F.when(F.col("_day").isNull(), F.lit(None).cast("int")).when(take_before, back).when(ahead.isNotNull(), ahead)
    found = placed.select("_key", "_day", pick.alias("_pick"), gap.alias("_gap")).where(F.col("_pick").isNotNull())
    return found.select("_key", "_day", F.struct(F.col("_gap").alias("gap"), F.col("_pick.c.*")).alias(match))


def join_lookup(base: DataFrame, lookup: DataFrame, base_key: str, base_day: Column, match: str) -> DataFrame:
    """``base`` with the struct found for its key and day; one row per base row."""
    found = lookup.select(F.col("_key"), F.col("_day"), F.col(match))
    cond = (F.col(base_key) == F.col("_key")) & base_day.cast("date").eqNullSafe(F.col("_day"))
    return base.join(found, cond, "left").drop("_key", "_day")


def nearest_by_day(
    base: DataFrame,
    cands: DataFrame,
    *,
    base_key: str,
    base_day: Column,
    cand_key: str,
    cand_day: Column,
    rank: Sequence[Column],
    carry: Sequence[str],
    match: str = "match",
) -> DataFrame:
    """Candidate of the same key nearest in days; undated candidates last; ``rank`` ascending settles ties.

    Adds a struct (``gap`` in days, the ``carry`` columns), NULL where the key has no candidate. ``rank``
    columns must not be NULL and must end in a unique one.
    """
    found = nearest_lookup(
        base, cands, base_key=base_key, base_day=base_day, cand_key=cand_key, cand_day=cand_day, rank=rank, carry=carry, match=match
    )
    return join_lookup(base, found, base_key, base_day, match)


def reverse_link(events: DataFrame, matched: DataFrame, event_id: str, match_id: str, base_id: str) -> DataFrame:
    """Each event with the base record it was matched to; an event first for several keeps the least one."""
    back = (
        matched.where(F.col(match_id).isNotNull())
        .groupBy(F.col(match_id).alias("_id"))
        .agg(F.min(base_id).alias(f"matched_{base_id}"))
    )
    return events.join(back, F.col(event_id) == F.col("_id"), "left").drop("_id")
