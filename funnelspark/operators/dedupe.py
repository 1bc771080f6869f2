"""Keep-one-per-key operators.

``row_number() = 1`` is planned with a per-task group limit below the shuffle, so a key that holds a
large share of all rows sends one row per map task instead of its whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given total order (state the nulls and the tie column in it)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Row with the greatest ``by`` per key, NULLs last; ``tie`` columns ascending settle equals."""
    order = [F.col(c).desc_nulls_last() for c in by] + [F.col(c).asc_nulls_last() for c in tie]
    return best(df, keys, order)


def earliest(df: DataFrame, keys: Sequence[str], by: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Row with the least ``by`` per key, NULLs last."""
    return best(df, keys, [F.col(c).asc_nulls_last() for c in (*by, *tie)])


def newest_pull(existing: DataFrame, new: DataFrame, keys: Sequence[str], pulled_at: str) -> DataFrame:
    """History plus a new pull, the newest pull of each key kept; the new side wins equal times."""
    both = existing.withColumn("_side", F.lit(0)).unionByName(
        new.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    return best(both, keys, [F.col(pulled_at).desc_nulls_last(), F.col("_side").desc()]).drop("_side")


def prefer_source(
    df: DataFrame, keys: Sequence[str], source: str, preference: Sequence[str], modified: str, tie: Sequence[str] = ()
) -> DataFrame:
    """One row per key from the most preferred source, the newest file within it."""
    rank = F.coalesce(*[F.when(F.col(source) == s, F.lit(i)) for i, s in enumerate(preference)], F.lit(len(preference)))
    order = [rank.asc(), F.col(modified).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie]
    return best(df, keys, order)


def mode_member(df: DataFrame, group: Sequence[str], member: Sequence[str], count: str = "rows") -> DataFrame:
    """Most frequent member of each group with its count; equal counts go to the least member."""
    counts = df.groupBy(*group, *member).agg(F.count(F.lit(1)).alias(count))
    return best(counts, group, [F.col(count).desc()] + [F.col(m).asc_nulls_last() for m in member])


def canonical_members(df: DataFrame, name: str, member: str) -> DataFrame:
    """Per member id its name's most frequent id: one row per id, so a join on it cannot fan out."""
    counts = df.groupBy(name, member).agg(F.count(F.lit(1)).alias("rows"))
    top = best(counts, [name], [F.col("rows").desc(), F.col(member).asc()]).select(
        name, F.col(member).alias(f"canonical_{member}"), F.col(name).alias(f"canonical_{name}")
    )
    own = best(counts, [member], [F.col("rows").desc(), F.col(name).asc_nulls_last()]).select(member, name)
    return own.join(top, name, "left").select(member, f"canonical_{member}", f"canonical_{name}")


def merged_members(df: DataFrame, name: str, member: str) -> DataFrame:
    """Names carried by more than one id, with the number of ids and rows."""
    return (
        df.groupBy(name, member)
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(name)
        .agg(F.count(member).alias("ids"), F.sum("rows").alias("rows"))
        .where("ids > 1")
    )


def flag_duplicates(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """Mark rows whose key occurs more than once and list the sources of such keys.

    Counts and source lists are aggregated per key before the join, so no group is gathered row by row.
    """
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.array_sort(F.collect_set(F.col(source).cast("string"))), " | ").alias("_sources"),
    )
    agg = agg.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n", "_sources")
    cond = None
    for i, k in enumerate(keys):
        part = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        cond = part if cond is None else cond & part
    out = df.join(agg, cond, "left")
    return out.select(
        *df.columns,
        (F.col("_n") > 1).alias("dup_flag"),
        F.when(F.col("_n") > 1, F.col("_sources")).alias("dup_sources"),
    )


def new_keys(df: DataFrame, seen: DataFrame, keys: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``seen``; NULL keys compare as equal."""
    pairs = keys.items() if isinstance(keys, Mapping) else [(k, k) for k in keys]
    right = seen.select(*[F.col(s).alias(f"_s{i}") for i, (_, s) in enumerate(pairs)]).distinct()
    cond = None
    for i, (k, _) in enumerate(pairs):
        part = F.col(k).eqNullSafe(F.col(f"_s{i}"))
        cond = part if cond is None else cond & part
    return df.join(right, cond, "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name, columns missing on one side filled with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def tagged_union(frames: Mapping[str, DataFrame], tag: str = "scenario") -> DataFrame:
    """Union of frames, each marked with its name."""
    return union_all(*[f.withColumn(tag, F.lit(name)) for name, f in frames.items()])
