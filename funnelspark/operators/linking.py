"""Entity linking: tiers of exact keys, nearest dates, and block-scoped name similarity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.functions.fuzzy import name_ratio
from funnelspark.operators.dedupe import best
from funnelspark.operators.intervals import nearest_by_day, nearest_lookup, null_spread
from funnelspark.session import materialise


@dataclass(frozen=True)
class Tier:
    """One exact-key attempt: key columns of both sides and the labels of a hit."""

    name: str
    base_key: str
    cand_key: str
    confidence: str


def tiered_link(
    base: DataFrame,
    cands: DataFrame,
    tiers: Sequence[Tier],
    *,
    base_day: Column,
    cand_day: Column,
    rank: Sequence[Column],
    carry: Sequence[str],
    unmatched: str = "unmatched",
) -> DataFrame:
    """Best candidate by tier order, then nearest date; every base row is kept once.

    The keys of all tiers are stacked, so one linear nearest-date pass answers every tier and the candidates are read once. It
    works on the distinct keys and dates of ``base``; the best tier of each such combination is joined back once, so the other
    columns of ``base`` are sent once, or not at all where the answers are small enough to be broadcast. Rows without any key
    are spread. Keys of a tier have one type on both sides. Adds ``carry`` columns, ``match_method`` and ``match_confidence``.
    """
    types = {base.schema[t.base_key].dataType for t in tiers} | {cands.schema[t.cand_key].dataType for t in tiers}

    def stack(df: DataFrame, names: Sequence[str]) -> DataFrame:
        keys = [F.col(n) if len(types) == 1 else F.col(n).cast("string") for n in names]
        return df.select("*", F.posexplode(F.array(*keys)).alias("_tier", "_part")).where("_part is not null").withColumn(
            "_tier_key", F.struct("_tier", "_part")
        )

    names = [f"_b{i}" for i in range(len(tiers))]
    keys = [F.col(t.base_key) for t in tiers]
    keyed = F.coalesce(*[k.cast("string") for k in keys]).isNotNull()
    combos = base.where(keyed).select(*[k.alias(n) for k, n in zip(keys, names)], base_day.cast("date").alias("_on")).distinct()
    probes = stack(combos, names)
    found = nearest_lookup(
        probes, stack(cands, [t.cand_key for t in tiers]), base_key="_tier_key", base_day=F.col("_on"), cand_key="_tier_key",
        cand_day=cand_day, rank=rank, carry=carry, match="_found",
    )
    cond = (F.col("_tier_key") == F.col("_key")) & F.col("_on").eqNullSafe(F.col("_day"))
    picked = (
        probes.join(found, cond).groupBy(*names, "_on").agg(F.min_by(F.struct("_tier", "_found"), "_tier").alias("_pick"))
        .select(*[F.col(n).alias(f"_p{n}") for n in names], F.col("_on").alias("_picked_on"), "_pick", F.lit(0).cast("long").alias("_picked_slot"))
    )
    slot = F.when(keyed, F.lit(0)).otherwise(null_spread(base)).cast("long")
    held = base.select("*", base_day.cast("date").alias("_on"), slot.alias("_slot"))
    same = F.col("_on").eqNullSafe(F.col("_picked_on")) & (F.col("_slot") == F.col("_picked_slot"))
    for k, n in zip(keys, names):
        same = same & k.eqNullSafe(F.col(f"_p{n}"))
    tier = F.col("_pick._tier")

    def label(values: Sequence[str]) -> Column:
        return F.coalesce(F.get(F.array(*[F.lit(v) for v in values]), tier), F.lit(unmatched))

    return held.join(picked, same, "left").select(
        *base.columns,
        *[F.col(f"_pick._found.{c}").alias(c) for c in carry],
        label([t.name for t in tiers]).alias("match_method"),
        label([t.confidence for t in tiers]).alias("match_confidence"),
    )


def nearest_with_confidence(
    base: DataFrame,
    cands: DataFrame,
    *,
    base_key: str,
    base_day: Column,
    cand_key: str,
    cand_day: Column,
    rank: Sequence[Column],
    carry: Sequence[str],
    high_days: int = 120,
) -> DataFrame:
    """Single-key nearest match graded by the gap in days: high, low, name_only (undated) or none."""
    out = nearest_by_day(
        base,
        cands,
        base_key=base_key,
        base_day=base_day,
        cand_key=cand_key,
        cand_day=cand_day,
        rank=rank,
        carry=carry,
        match="_m",
    )
    grade = (
        F.when(F.col("_m").isNull(), F.lit("none"))
        .when(F.col("_m.gap").isNull(), F.lit("name_only"))
        .when(F.col("_m.gap") <= high_days, F.lit("high"))
        .otherwise(F.lit("low"))
    )
    return out.select(
        *base.columns,
        *[F.col(f"_m.{c}").alias(c) for c in carry],
        F.when(F.col("_m").isNull(), F.lit("unmatched")).otherwise(F.lit("matched")).alias("match_status"),
        grade.alias("match_confidence"),
    )


def _gram_length(threshold: int) -> int:
    """The longest grams of which two names at the threshold still share one: (2q - 1) t >= 200 (q - 1)."""
    return next(q for q in (5, 4, 3, 2) if (2 * q - 1) * threshold >= 200 * (q - 1))


def _named_grams(rows: DataFrame, block: str, name: str, q: int) -> DataFrame:
    """(block, name, size, letters, gram, at) of distinct names. The k-th copy of a gram in a name is a gram of its own; ``at`` is NULL where
    there are copies. ``letters`` has a bit set for each letter and copy: an insertion or deletion changes at most one of them."""
    ends = ["\u0002" * (q - 1), "\u0003" * (q - 1)]
    names = rows.where(F.col(block).isNotNull() & (F.length(name) > 0)).select(F.col(block).alias("block"), F.col(name).alias("name")).distinct()
    padded = names.withColumn("size", F.length("name")).withColumn("padded", F.concat(F.lit(ends[0]), "name", F.lit(ends[1])))
    grams = padded.withColumn("grams", F.transform(F.sequence(F.lit(1), F.col("size") + (q - 1)), lambda i: F.substring("padded", i, F.lit(q))))
    copies = lambda x, of: F.size(F.filter(of, lambda y: y == x))
    letters = grams.withColumn("letters", F.transform(F.sequence(F.lit(1), F.col("size")), lambda i: F.substring("name", i, F.lit(1))))
    bit = F.transform("letters", lambda x, i: F.pmod(F.hash(x, copies(x, F.slice("letters", F.lit(1), i))), F.lit(64)))
    set_bit = lambda mask, b: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
    grams = letters.withColumn("letters", F.aggregate(bit, F.lit(0).cast("long"), set_bit))
    marked = F.transform(
        "grams",
        lambda x, i: F.struct(
            F.concat(x, copies(x, F.slice("grams", F.lit(1), i)).cast("string")).alias("gram"), F.when(copies(x, F.col("grams")) == 1, i).alias("at")
        ),
    )
    return grams.select("block", "name", "size", "letters", F.inline(marked))


def candidate_pairs(left: DataFrame, right: DataFrame, block: str, name: str, threshold: int) -> DataFrame:
    """(block, left_name, right_name), each pair once: names that share a rare gram and are close enough by letters and edit distance to be scored.

    A superset of all pairs with an indel ratio of at least ``threshold`` = t. Such names of lengths m and n have a common subsequence of
    c >= t (m + n) / 200 letters: m - c deletions break at most q grams each, n - c insertions q - 1 each. So in an order common
    to all names, the rarest grams first, both have a shared gram among their first q (m - c) + (q - 1) (n - c) + 1, at places
    shifted by no more than the insertions and deletions, and their letters differ in no more copies than ``most`` = m + n - 2c. Only
    these grams are indexed and looked up; the letters are compared as bits of one word, then the edit distance (never above ``most``),
    inside the join. What leaves it hardly grows with the block; the rows met inside it do, as the squares of the grams' frequencies.
    """
    t, q = int(threshold), _gram_length(int(threshold))
    probe, index = _named_grams(left, block, name, q), _named_grams(right, block, name, q)
    often = index.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))

    def first(grams: DataFrame) -> DataFrame:
        rarest = Window.partitionBy("block", "name").orderBy(F.coalesce("often", F.lit(0)), "gram")
        ranked = grams.join(often, "gram", "left").withColumn("rank", F.row_number().over(rarest) - 1)
        return ranked.where(F.expr(f"rank <= {q} * size * {200 - 2 * t} div {200 - t}"))

    a = first(probe).select("block", "gram", F.col("name").alias("left_name"), F.col("size").alias("m"), F.col("letters").alias("x"), F.col("at").alias("i"), F.col("rank").alias("j"))
    b = first(index).select("block", "gram", F.col("name").alias("right_name"), F.col("size").alias("n"), F.col("letters").alias("y"), F.col("at").alias("k"), F.col("rank").alias("l"))
    common = f"(({t} * (m + n) + 199) div 200)"
    gone, come = f"(m - {common})", f"(n - {common})"
    fits = (
        f"bit_count(x ^ y) <= {gone} + {come} AND {gone} >= 0 AND {come} >= 0 AND j <= {q} * {gone} + {q - 1} * {come} AND l <= {q} * {come} + {q - 1} * {gone}"
        f" AND coalesce(k - i BETWEEN -{gone} AND {come}, true)"
    )
    met = a.join(b, ["block", "gram"]).where(fits).where(F.levenshtein("left_name", "right_name") <= F.expr(f"{gone} + {come}"))
    return met.select("block", "left_name", "right_name").distinct()


def similar_pairs(left: DataFrame, right: DataFrame, block: str, name: str, threshold: int) -> DataFrame:
    """All (block, left name, right name) pairs with an indel ratio of at least ``threshold``, scored.

    Exact, without scoring a whole block: only :func:`candidate_pairs` are scored. Names are made distinct first.
    """
    if not 67 <= threshold <= 100:
        raise ValueError("threshold must be between 67 and 100")
    pairs = candidate_pairs(left, right, block, name, threshold)
    # Out of an explode: a filter on a plain column would be moved below it and score every pair twice.
    scored = pairs.select("*", F.explode(F.array(name_ratio(F.col("left_name"), F.col("right_name")))).alias("score"))
    return scored.where(F.col("score") >= int(threshold))


def block_match(
    base: DataFrame,
    cands: DataFrame,
    *,
    base_block: str,
    cand_block: str,
    base_id_key: str,
    cand_id_key: str,
    base_name: str,
    cand_name: str,
    prefer: Sequence[Column],
    carry: Sequence[str],
    threshold: int = 88,
    labels: Sequence[str] = ("id + block", "name + block", "name fuzzy", "no match", "no match (unmapped block)"),
    exact_scores: Sequence[int] = (100, 95),
) -> DataFrame:
    """Within a block: exact id, then exact name, then the most similar name at or above ``threshold``.

    ``prefer`` orders candidates that share a key (admitted first, newest, ...) and must be total; the
    choice does not depend on the base row, so candidates are cut to one per block and key before joining.
    """
    def top(key: str, suffix: str) -> DataFrame:
        d = cands.where(F.col(cand_block).isNotNull() & F.col(key).isNotNull() & (F.col(key) != ""))
        d = best(d, [cand_block, key], prefer)
        return d.select(
            F.col(cand_block).alias(f"_b{suffix}"),
            F.col(key).alias(f"_k{suffix}"),
            F.struct(*carry).alias(f"_c{suffix}"),
        )

    by_id, by_name = top(cand_id_key, "1"), top(cand_name, "2")
    out = base.join(by_id, (F.col(base_block) == F.col("_b1")) & (F.col(base_id_key) == F.col("_k1")), "left")
    out = out.join(by_name, (F.col(base_block) == F.col("_b2")) & (F.col(base_name) == F.col("_k2")), "left")
    left = (
        out.where(F.col("_c1").isNull() & F.col("_c2").isNull())
        .select(F.col(base_block).alias("block"), F.col(base_name).alias("name"))
    )
    right = cands.select(F.col(cand_block).alias("block"), F.col(cand_name).alias("name"))
    pairs = similar_pairs(left, right, "block", "name", threshold)
    ranked = best(cands.where(F.col(cand_name).isNotNull()), [cand_block, cand_name], prefer)
    ranked = ranked.select(
        F.col(cand_block).alias("block"), F.col(cand_name).alias("right_name"), F.struct(*carry).alias("_c3")
    )
    w = Window.partitionBy("block", "left_name").orderBy(F.col("score").desc(), F.col("right_name").asc())
    fuzzy = (
        pairs.withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .join(ranked, ["block", "right_name"])
        .select(F.col("block").alias("_b3"), F.col("left_name").alias("_k3"), "_c3", F.col("score").alias("_score"))
    )
    exact = F.col("_c1").isNotNull() | F.col("_c2").isNotNull()
    out = out.join(
        fuzzy, ~exact & (F.col(base_block) == F.col("_b3")) & (F.col(base_name) == F.col("_k3")), "left"
    )
    method = (
        F.when(F.col(base_block).isNull(), F.lit(labels[4]))
        .when(F.col("_c1").isNotNull(), F.lit(labels[0]))
        .when(F.col("_c2").isNotNull(), F.lit(labels[1]))
        .when(F.col("_c3").isNotNull(), F.lit(labels[2]))
        .otherwise(F.lit(labels[3]))
    )
    score = (
        F.when(F.col("_c1").isNotNull(), F.lit(exact_scores[0]))
        .when(F.col("_c2").isNotNull(), F.lit(exact_scores[1]))
        .when(F.col("_c3").isNotNull(), F.floor("_score").cast("int"))
        .otherwise(F.lit(0))
    )
    return out.withColumn("_c", F.coalesce("_c1", "_c2", "_c3")).select(
        *base.columns,
        *[F.col(f"_c.{c}").alias(c) for c in carry],
        method.alias("match_method"),
        score.alias("match_confidence"),
    )


def reasoned_match(
    base: DataFrame,
    cands: DataFrame,
    *,
    base_block: str,
    cand_block: str,
    base_id_key: str,
    cand_id_key: str,
    base_name: str,
    cand_name: str,
    base_day: Column,
    cand_day: Column,
    prefer: Sequence[Column],
    rank: Sequence[Column],
    carry: Sequence[str],
    threshold: int = 80,
) -> DataFrame:
    """Two tiers with stated reasons: exact id in the block, else the most similar name, nearest in days.

    Several names can share the best score; the nearest dated candidate among them wins. Rows left over
    say whether the block is unknown to the candidates or no name reached the threshold. Runs one job: the
    scored names are written to the shared folder.
    """
    ids = cands.where(F.col(cand_block).isNotNull() & F.col(cand_id_key).isNotNull())
    tier1 = best(ids, [cand_block, cand_id_key], prefer).select(
        F.col(cand_block).alias("_b1"), F.col(cand_id_key).alias("_k1"), F.struct(*carry).alias("_c1")
    )
    out = base.join(tier1, (F.col(base_block) == F.col("_b1")) & (F.col(base_id_key) == F.col("_k1")), "left")
    todo = (
        out.where(F.col("_c1").isNull())
        .select(F.col(base_block).alias("block"), F.col(base_name).alias("left_name"), base_day.cast("date").alias("day"))
        .distinct()
    )
    pairs = similar_pairs(
        todo.select("block", F.col("left_name").alias("name")),
        cands.select(F.col(cand_block).alias("block"), F.col(cand_name).alias("name")),
        "block",
        "name",
        threshold,
    )
    tied = Window.partitionBy("block", "left_name").orderBy(F.col("score").desc())
    top = pairs.withColumn("_r", F.rank().over(tied)).where("_r = 1").drop("_r")
    # scored once and written: the nearest-date pass below reads it twice
    wanted = materialise(
        todo.join(top, ["block", "left_name"]).withColumn(
            "_pair", F.to_json(F.struct("block", F.col("right_name").alias("name")))
        ),
        "name-pairs",
    )
    pool = cands.withColumn("_pair", F.to_json(F.struct(F.col(cand_block).alias("block"), F.col(cand_name).alias("name"))))
    near = nearest_by_day(
        wanted,
        pool,
        base_key="_pair",
        base_day=F.col("day"),
        cand_key="_pair",
        cand_day=cand_day,
        rank=rank,
        carry=carry,
        match="_m",
    )
    w = Window.partitionBy("block", "left_name", "day").orderBy(
        F.col("_m.gap").asc_nulls_last(), F.col("right_name").asc()
    )
    tier2 = (
        near.withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .select(
            F.col("block").alias("_b2"),
            F.col("left_name").alias("_k2"),
            F.col("day").alias("_d2"),
            F.struct(*[F.col(f"_m.{c}").alias(c) for c in carry]).alias("_c2"),
            F.col("score").alias("_score"),
        )
    )
    blocks = cands.where(F.col(cand_block).isNotNull()).select(F.col(cand_block).alias("_known")).distinct()
    out = out.join(
        tier2,
        F.col("_c1").isNull()
        & (F.col(base_block) == F.col("_b2"))
        & (F.col(base_name) == F.col("_k2"))
        & base_day.cast("date").eqNullSafe(F.col("_d2")),
        "left",
    ).join(blocks, F.col(base_block) == F.col("_known"), "left")
    method = (
        F.when(F.col("_c1").isNotNull(), F.lit("Tier 1: id + block"))
        .when(
            F.col("_c2").isNotNull(),
            F.concat(F.lit("Tier 2: name + block (sim="), F.floor("_score").cast("string"), F.lit(")")),
        )
        .when(F.col("_known").isNull(), F.lit("No match (block unknown)"))
        .otherwise(F.lit("No match (name below threshold)"))
    )
    return out.withColumn("_c", F.coalesce("_c1", "_c2")).select(
        *base.columns, *[F.col(f"_c.{c}").alias(c) for c in carry], method.alias("match_method")
    )
