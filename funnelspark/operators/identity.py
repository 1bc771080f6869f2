"""Identity closure: alias pairs to one canonical id per group of ids that name the same thing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.session import materialise


def closed_groups(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, least): the smallest id that any chain of pairs reaches, for every id of a pair. Chains and cycles end at one id.

    Each round an id takes the least label around it and then that label's own, so a chain halves. Rounds are stored, minima are combined
    before their shuffle, and an id in very many pairs is one row of the labels. Pairs with a NULL are left out. The labels are
    joined by shuffle: where they are small enough to be broadcast, they would go through the driver several times a round.
    """
    sides = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").distinct()
    edges = materialise(sides.union(sides.select("b", "a")).distinct(), "identity-pairs")
    labels = materialise(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("least")), "identity-labels")
    while True:
        around = edges.join(labels.withColumnRenamed("id", "b").hint("merge"), "b").groupBy(F.col("a").alias("id")).agg(F.min("least").alias("_near"))
        near = labels.join(around.hint("merge"), "id").select("id", F.col("least").alias("_was"), F.least("least", "_near").alias("_at"))
        jump = labels.select(F.col("id").alias("_at"), F.col("least").alias("_further"))
        step = near.join(jump.hint("merge"), "_at", "left").select("id", "_was", F.least("_at", F.coalesce("_further", "_at")).alias("least"))
        step = materialise(step, "identity-labels")
        labels = step.select("id", "least")
        if step.where(F.col("least") != F.col("_was")).isEmpty():
            return labels


def canonical_ids(pairs: DataFrame, a: str, b: str, members: DataFrame | None = None, prefer: Column | None = None) -> DataFrame:
    """(id, canonical, group_size): the preferred member of each closed group.

    Without ``members`` that is the smallest id. With it (a frame with ``id``), the id with the least ``prefer`` value, ties to the smaller
    id; ids that ``members`` lacks come after all others.
    """
    groups = closed_groups(pairs, a, b)
    if members is None:
        ranked = groups.withColumn("_rank", F.struct(F.lit(0).alias("x"), F.col("id").alias("i")))
    else:
        known = members.groupBy(F.col("id").alias("_id")).agg(F.min(prefer).alias("_p"))
        ranked = groups.join(known, F.col("id") == F.col("_id"), "left").withColumn("_rank", F.struct(F.col("_p").isNull().alias("n"), F.col("_p").alias("p"), F.col("id").alias("i")))
    best = ranked.groupBy("least").agg(F.min("_rank").alias("_best"), F.count(F.lit(1)).alias("group_size"))
    return groups.join(best, "least").select("id", F.col("_best.i").alias("canonical"), "group_size")
