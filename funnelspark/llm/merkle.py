"""Merkle manifest of a dataset, and proofs by a recursive query that climbs it.

1. *Leaves.* A row is hashed from its fields. Rows are numbered per source in order of their id by range partitions: positions inside a
   partition plus the rows of the source in earlier ones, so a source that holds most rows is dealt over as many tasks as it needs.
2. *Levels.* Every ``width`` consecutive nodes become their parent, source by source, then over the sources' last nodes. Each built
   level is stored as node rows (node, parent, digests of the siblings before and after it), partitioned by level.
3. *Climb.* ``WITH RECURSIVE``: a row starts at each lowest run and ascends node by node to the root, appending the siblings it passes
   and folding the digest of each leaf of the run, tampered where the leaf was. Leaves of a run share all siblings above it, so
   they ride in one row, and a step moves some 70 bytes a leaf.

Digests are kept as 32 bytes and hashed as lower-case hexadecimal text. A step joins on the node; nothing but the root and the greatest
source size reaches the driver. The climb's steps are shuffled by Spark, so a lost executor costs the recomputation of its part.

Defined results: NULL fields hash as ``-``, empty texts as ``0:``; rows without an id come first in their source and are never tampered with;
rows of one id are ordered by their digest; repeated rows are leaves of their own; the NULL source is a source; a single leaf is the subroot
of its source and, alone in the table, the root, its proof the hash of nothing; an empty table has no rows and no root; columns not
named in ``fields`` are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from funnelspark.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tree number of the nodes above the sources.
TOP = -1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A field as hashed: ``-`` for NULL, else its UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def sampled(doc_id: Column, modulus: int = 5) -> Column:
    """True for the ids whose decimal text has a crc32 that ``modulus`` divides."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 0, F.lit(False))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaves(docs: DataFrame, tampered: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """(doc_id, source, leaf, folded): digests of each row, and of the row with the columns of ``tampered`` in place of its own."""
    changed = tampered or {}
    leaf = _sha(F.concat(*(field(F.col(c)) for c in fields)))
    folded = _sha(F.concat(*(field(changed.get(c, F.col(c))) for c in fields))) if changed else leaf
    return docs.select("doc_id", "source", leaf.alias("leaf"), folded.alias("folded"))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``tree`` (number of the group, NULL first), ``at`` (position in the group, from 0) and ``left`` (rows of the group).

    One range shuffle; what is summed over is a row per partition and group that meet, and the windows hold a group's partitions
    or a partition's groups, never a group's rows.
    """
    keys = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    placed = rows.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id())
    placed = materialise(placed, "merkle-placed")
    counts = materialise(placed.groupBy("_p", group).agg(F.count(F.lit(1)).alias("_n")), "merkle-counts")
    before = Window.partitionBy(group).orderBy("_p")
    counts = counts.withColumn("_before", F.sum("_n").over(before) - F.col("_n")).withColumn("_first", F.min("_p").over(Window.partitionBy(group)))
    counts = counts.withColumn("left", F.sum("_n").over(Window.partitionBy(group)))
    # Groups that begin in a partition come after all that begin in an earlier one.
    begins = counts.where("_first = _p").select("_p", F.col(group).alias("_g"), F.row_number().over(Window.partitionBy("_p").orderBy(F.col(group).asc_nulls_first())).alias("_k"))
    parts = begins.groupBy("_p").agg(F.count(F.lit(1)).alias("_groups"))
    # No partition key: at most one row per shuffle partition.
    parts = parts.withColumn("_earlier", F.sum("_groups").over(Window.orderBy("_p")) - F.col("_groups")).select(F.col("_p").alias("_q"), "_earlier")
    begins = begins.join(parts, begins["_p"] == parts["_q"]).select("_g", (F.col("_earlier") + F.col("_k") - 1).alias("tree"))
    counts = counts.join(begins, counts[group].eqNullSafe(begins["_g"])).select(F.col("_p").alias("_q"), "_g", "_before", "left", "tree")
    joined = placed.join(counts, (placed["_p"] == counts["_q"]) & placed[group].eqNullSafe(counts["_g"]))
    inside = Window.partitionBy("_p", group).orderBy(*keys[1:])
    return joined.withColumn("at", F.col("_before") + F.row_number().over(inside) - 1).select(*rows.columns, "tree", "at", "left")


def _name(tree: Column, level: int, at: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(level).cast("string"), at.cast("string"))


def _runs(nodes: DataFrame, width: int, *columns: str) -> DataFrame:
    """(tree, at, left, was, run): each ``width`` consecutive nodes of a tree as one row, in order; the tree had ``was`` nodes and has ``left`` runs."""
    run = F.array_sort(F.collect_list(F.struct("at", *columns))).alias("run")
    grouped = nodes.groupBy("tree", F.floor(F.col("at") / width).cast("long").alias("up"), F.col("left").alias("was")).agg(run)
    return grouped.select("tree", F.col("up").alias("at"), F.ceil(F.col("was") / width).cast("long").alias("left"), "was", "run")


def _joined(run: Column) -> Column:
    return F.concat_ws("", F.transform(run, lambda d: _hex(d.digest)))


def _linked(runs: DataFrame) -> DataFrame:
    """Node rows of runs (run, parent): each member with its parent and the digests beside it, end to end."""
    side = lambda start, n: F.unhex(F.concat_ws("", F.transform(F.slice("run", start, n), lambda d: F.hex(d.digest))))
    each = runs.select("run", "parent", F.posexplode("run").alias("_i", "_d"))
    return each.select(
        F.col("_d.node").alias("node"), "parent", side(F.lit(1), F.col("_i")).alias("before"),
        side(F.col("_i") + 2, F.size("run")).alias("after"), F.col("_d.digest").alias("digest"),
    )


def _levels(nodes: DataFrame, level: int, width: int) -> tuple[DataFrame | None, DataFrame]:
    """Stored node rows of all levels above ``nodes`` (tree, at, left, digest, node), and the last node of each tree: (tree, digest, node)."""
    most = nodes.agg(F.max("left")).first()[0] or 0
    stored, last = None, nodes.where("left = 1").select("tree", "digest", "node")
    while most > 1:
        level += 1
        runs = _runs(nodes.where("left > 1"), width, "digest", "node").withColumn("parent", _name(F.col("tree"), level, F.col("at")))
        runs = materialise(runs.withColumn("digest", _sha(_joined(F.col("run")))), f"merkle-level-{level}")
        stored = _linked(runs) if stored is None else stored.union(_linked(runs))
        nodes = runs.select("tree", "at", "left", "digest", F.col("parent").alias("node"))
        last = last.union(nodes.where("left = 1").select("tree", "digest", "node"))
        most = -(-most // width)
    return stored, last


#: Ascends from the lowest runs. A row holds the folded digests of its leaves, the siblings passed so far, and the subroot once met.
CLIMB = """
WITH RECURSIVE climb(start, at, folded, passed, subroot) AS (
  SELECT start, start, folded, CAST('' AS BINARY), CAST(NULL AS BINARY) FROM {lowest}
  UNION ALL
  SELECT c.start, n.parent,
         transform(c.folded, f -> unhex(sha2(lower(concat(hex(n.before), hex(f), hex(n.after))), 256))),
         concat(c.passed, n.before, n.after),
         coalesce(c.subroot, CASE WHEN startswith(n.parent, '-1/') THEN n.digest END)
  FROM climb c JOIN {nodes} n ON c.at = n.node
)
SELECT start, folded, passed, subroot FROM climb WHERE at = :root
"""


def climb(lowest: DataFrame, nodes: DataFrame, root: str) -> DataFrame:
    """The rows of ``lowest`` (start, folded digests) as they reach the root: (start, folded, passed, subroot), stored.

    The stored levels bound the recursion; Spark's default limit on the rows of a recursive query is lifted meanwhile.
    """
    spark, key = lowest.sparkSession, "spark.sql.cteRecursionRowLimit"
    limit = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return materialise(spark.sql(CLIMB, args={"root": root}, lowest=lowest, nodes=nodes), "merkle-climb")
    finally:
        spark.conf.set(key, limit)


def manifest(rows: DataFrame, width: int = 16) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lowest runs, node rows, last node of each source and of all) of :func:`leaves`, all stored.

    Lowest runs hold tree, start (the node to climb from), digest and run: array of at, digest, doc_id, folded.
    """
    nodes = numbered(rows, "source", ["doc_id", "leaf"]).withColumnRenamed("leaf", "digest")
    runs = _runs(nodes, width, "digest", "doc_id", "folded")
    # A leaf alone in its source is no run: it stands in the tree above under its own name.
    alone = F.col("was") == 1
    runs = runs.withColumn("alone", alone).withColumn("start", F.when(alone, _name(F.col("tree"), 0, F.col("at"))).otherwise(_name(F.col("tree"), 1, F.col("at"))))
    runs = materialise(runs.withColumn("digest", F.when(alone, F.col("run")[0]["digest"]).otherwise(_sha(_joined(F.col("run"))))), "merkle-runs")
    stored, last = _levels(runs.select("tree", "at", "left", "digest", F.col("start").alias("node")), 1, width)
    last = materialise(last, "merkle-subroots")
    sources = last.count()
    above, root = _levels(last.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(sources).cast("long").alias("left"), "digest", "node"), 0, width)
    parts = [p for p in (stored, above) if p is not None]
    if not parts:
        parts = [last.select("node", F.col("node").alias("parent"), *(F.col("digest").alias(c) for c in ("before", "after", "digest"))).where("false")]
    linked = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    return runs, materialise(linked, "merkle-nodes"), root


def prove(docs: DataFrame, tampered: dict[str, Column] | None = None, width: int = 16, fields: Sequence[str] = FIELDS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; digests as hexadecimal text.

    ``tampered`` gives changed columns; the folded root starts from the changed row and the stored siblings.
    """
    runs, nodes, last = manifest(materialise(leaves(docs, tampered, fields), "merkle-leaves"), width)
    top = last.first()  # one row: the root
    root = _hex(F.lit(bytes(top["digest"]) if top else None).cast("binary"))
    others = lambda i: F.concat(F.slice("run", F.lit(1), i), F.slice("run", i + 2, F.size("run")))
    fold = F.transform("run", lambda d, i: _sha(F.concat(_joined(F.slice("run", F.lit(1), i)), _hex(d.folded), _joined(F.slice("run", i + 2, F.size("run"))))))
    lowest = runs.select("start", F.when(F.col("alone"), F.transform("run", lambda d: d.folded)).otherwise(fold).alias("folded"))
    done = climb(lowest, nodes, top["node"] if top else "")
    met = runs.select("start", "run").join(done, "start")
    met = met.select("run", "folded", _hex(F.col("passed")).alias("passed"), _hex(F.col("subroot")).alias("subroot"))
    each = met.select("run", "folded", "passed", "subroot", F.posexplode("run").alias("i", "d"))
    folded_root = _hex(F.get("folded", F.col("i")))
    return each.select(
        F.col("d.doc_id").alias("doc_id"), _hex(F.col("d.digest")).alias("leaf"), F.coalesce("subroot", root).alias("subroot"), root.alias("root"),
        F.sha2(F.concat(_joined(others(F.col("i"))), F.col("passed")), 256).alias("proof_sha256"),
        folded_root.alias("folded_root"), (folded_root == root).alias("verified"),
    )
