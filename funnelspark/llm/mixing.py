"""Mixing sources to target weights under weight schedules that vary over training.

Each source has a target number of words (its share of all words, capped at ``most_epochs`` times its own size, the excess
shared again by weight). Its documents are taken in a keyed order, whole passes first, then part of a further pass, so a
document is taken floor or ceil of target / size times; the one at the edge gives the words still missing. The schedule of
a source (piecewise linear weight over time 0..1) is integrated to a cumulative demand; a document's place in its source's
demand is inverted to a training time for every pass it is taken in, and all documents are range-sorted by the first of these.

All sums are two-level: a source's documents fall into 4,096 cells by their keyed hash; running totals go over cells
(a few thousand rows a source), then inside a cell, so a source with a third of all rows is spread over all tasks.

Defined results: a NULL text has size 0 and is taken 0 times at its place; a NULL source is a source of its own, after all others;
repeated rows count each; an empty table gives an empty result; documents with equal hashes keep the order of their ids and texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from funnelspark.session import materialise

#: Leading hex digits of the key that name a cell: 4,096 cells a source. More cells than a source has rows do no harm.
CELL_DIGITS = 3
#: Default schedules by rank of the weight cycle, as (time, relative weight) knots: early, flat and late sources.
SCHEDULES = (((0.0, 2.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 2.0)))
SPACES = "\\x20\\x09-\\x0D"


def word_count(text: Column) -> Column:
    """Number of maximal runs without space or the control characters 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most_epochs: float = 3.0, cycle: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, rank, target): shares by weight 1..cycle, with a cap and resharing.

    One row per source. The level L with sum(min(cap, weight * L)) = total is found from the sources in order of cap / weight;
    the windows run over sources only, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", (F.col("rank") % cycle + 1).cast("double"))
    rank = rank.withColumn("cap", F.col("source_size") * F.lit(float(most_epochs))).withColumn("turn", F.col("cap") / F.col("weight"))
    before = Window.orderBy("turn", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rank = (
        rank.withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("past", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # If this source were the first that is not capped, the level would be:
        .withColumn("level", (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("past")))
    )
    free = F.col("level") <= F.col("turn")
    rank = rank.withColumn("level", F.min_by(F.when(free, F.col("level")), F.when(free, F.struct("turn", "rank"))).over(whole))
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap"), F.col("weight") * F.coalesce(F.col("level"), F.col("turn"))))
    return rank.select("source", "source_size", "rank", target.alias("target"))


def _inverse_demand(share: Column, knots: Column) -> Column:
    """Time at which the integral of a piecewise linear weight reaches ``share`` of its whole.

    ``knots`` is an array of (t0, w0, t1, w1, before, area): segments with their part of the integral before them.
    """
    seg = F.element_at(F.filter(knots, lambda s: (s.before <= share) | (s.before == 0)), -1)
    slope = (seg.w1 - seg.w0) / (seg.t1 - seg.t0)
    need = F.greatest(share - seg.before, F.lit(0.0))
    # Solves w0 * x + slope * x^2 / 2 = need in the form that stays exact for slope 0.
    x = 2 * need / (seg.w0 + F.sqrt(F.greatest(seg.w0 * seg.w0 + 2 * slope * need, F.lit(0.0))))
    return F.least(seg.t0 + F.coalesce(x, F.lit(0.0)), seg.t1)


def _segments(knots: tuple[tuple[float, float], ...]) -> Column:
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append(F.struct(*(F.lit(v).alias(n) for n, v in zip(("t0", "w0", "t1", "w1", "before"), (t0, w0 / whole, t1, w1 / whole, before)))))
        before += (t1 - t0) * (w0 + w1) / 2 / whole
    return F.array(*out)


def mix(docs: DataFrame, most_epochs: float = 3.0, seed: int = 7, schedules=SCHEDULES, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, position, positions.

    ``positions`` are the training times of the row's first words in every pass it is taken in (a partial last pass included);
    ``position`` is the first of them. Texts are read once; sizes and order keys (some 60 bytes a row) are kept in the shared folder.
    Rows come range-sorted by position; those never taken are last, with a NULL position and no positions.
    """
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    rows = docs.select("doc_id", "source", word_count(F.col(text)).alias("size"), key.alias("_h"))
    rows = materialise(rows.withColumn("_cell", F.substring("_h", 1, CELL_DIGITS)), "mixing")
    return _mixed(rows, most_epochs, schedules)


def _mixed(rows: DataFrame, most_epochs: float, schedules) -> DataFrame:
    cells = rows.groupBy("source", "_cell").agg(F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("_sum").alias("source_size")), most_epochs)
    over = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_sum").over(over), F.lit(0)))
    plan = cells.join(targets, cells.source.eqNullSafe(targets.source)).select(
        cells.source.alias("_s"), F.col("_cell").alias("_c"), "_before", "source_size", "rank", "target"
    )
    joined = rows.join(plan, rows.source.eqNullSafe(plan._s) & (rows._cell == plan._c))
    inside = Window.partitionBy("source", "_cell").orderBy("_h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    passes = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    rest = F.round(F.col("target") - F.col("_passes") * F.col("source_size")).cast("long")
    kinds = F.array(*(_segments(s) for s in schedules))
    joined = (
        joined.withColumn("_at", at).withColumn("_passes", passes).withColumn("_rest", rest)
        .withColumn("taken", F.col("_passes") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_at"))))
        .withColumn("_knots", F.element_at(kinds, (F.col("rank") % len(schedules) + 1).cast("int")))
        # Passes a row is taken in: whole ones, and the partial one if the words missing reach it.
        .withColumn("_last", F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size")).cast("long") - 1))
        .withColumn("position", F.when(F.col("taken") > 0, _inverse_demand(F.col("_at") / F.col("target"), F.col("_knots"))))
    )
    time = lambda k: _inverse_demand((F.col("_at") + k * F.col("source_size")) / F.col("target"), F.col("_knots"))
    positions = F.when(F.col("taken") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("_last")), time)).otherwise(F.array().cast("array<double>"))
    out = joined.withColumn("positions", positions).select("doc_id", "source", "size", "source_size", "target", "taken", "position", "positions", "_h")
    return out.repartitionByRange(F.col("position").asc_nulls_last(), "_h").sortWithinPartitions(F.col("position").asc_nulls_last(), "_h").drop("_h")


def schedule(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`mix` once per pass they are taken in: doc_id, source, epoch (from 0), words taken in it, position; range-sorted by position."""
    each = mixed.select("doc_id", "source", "size", "taken", F.posexplode("positions").alias("epoch", "position"))
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    each = each.select("doc_id", "source", "epoch", words.alias("words"), "position")
    return each.repartitionByRange("position", "epoch", "doc_id").sortWithinPartitions("position", "epoch", "doc_id")
