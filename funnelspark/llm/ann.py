"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into balanced parts (recursive spectral bisection at the median, then swaps that keep
the balance); a small network learns which parts hold a vector's neighbours. Every vector is indexed under its most probable
part; a query visits its most probable parts until their summed probability reaches a level and they hold more than k rows, and
what it meets is ranked by exact distance. The level is the smallest that reaches ``recall`` for calibration queries, which the
router was not fitted on and whose neighbours are found by brute force over all rows in blocks.

Bounds: the sample (``SAMPLE`` vectors), ``CALIBRATION`` queries and ``PARTS`` parts, whatever the input. All rows are indexed.
Beyond ``PARTS`` times ``PART_ROWS`` rows parts grow with the input, and with them what a query meets.
Parts are dealt out in blocks of ``BLOCK`` rows (and blocks of queries), so a part that holds a third of all rows is shared out.

Defined results: NULL ids, NULL, zero and non-finite vectors and vectors of another than the usual length take no part; rows of
one id count as one (their least vector); equal distances go to the smaller id; with fewer than k candidates all are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from funnelspark.session import materialise

SAMPLE = 8192
CALIBRATION = 128
PARTS = 256
PART_ROWS = 2048
BLOCK = 1024
QUERY_BLOCK = 16_384


def _graph(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (both directions, without repeats) to the k nearest vectors."""
    n, k = len(x), min(k, len(x) - 1)
    square = (x * x).sum(1)
    near = []
    for a in range(0, n, 128):
        d = square[None] - 2 * x[a : a + 128] @ x.T
        d[np.arange(d.shape[0]), np.arange(a, a + d.shape[0])] = np.inf
        near.append(np.argpartition(d, k - 1, axis=1)[:, :k].copy() if k else np.zeros((d.shape[0], 0), int))
    v = np.concatenate(near).reshape(-1)
    u = np.repeat(np.arange(n), k)
    key = np.unique(np.concatenate((u * n + v, v * n + u)))
    return key // n, key % n


def _bisect(n: int, u: np.ndarray, v: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Two halves of a graph: order along its slowest mode, cut at the median, swap pairs while that cuts fewer edges."""
    degree = np.bincount(u, minlength=n) + 1e-9
    root = np.sqrt(degree)
    x = np.cos(np.arange(n) * 2.399963) + 1e-3 * np.arange(n) / n
    for _ in range(rounds):
        x -= root * (root @ x) / (root @ root)
        x = 0.5 * (x + np.bincount(u, weights=(x / root)[v], minlength=n) / root)
        x /= max(np.linalg.norm(x), 1e-12)
    side = np.zeros(n, bool)
    side[np.argsort(x / root, kind="stable")[n // 2 :]] = True
    for _ in range(8):
        cross = side[u] != side[v]
        gain = np.bincount(u, weights=np.where(cross, 1.0, -1.0), minlength=n)
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b), max(n // 50, 1))
        good = gain[a[:m]] + gain[b[:m]] > 2
        a, b = a[:m][good], b[:m][good]
        if not len(a):
            break
        trial = side.copy()
        trial[a], trial[b] = False, True
        if (trial[u] != trial[v]).sum() >= cross.sum():
            break
        side = trial
    return side


def balanced_parts(x: np.ndarray, parts: int, k: int = 10) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part of each vector (sizes differ by the halving only), and the graph's edges."""
    u, v = _graph(x, k)
    part = np.zeros(len(x), np.int64)
    count = 1
    while count < parts:
        for p in range(count):
            own = np.flatnonzero(part == p)
            if len(own) < 2:
                continue
            new = np.full(len(x), -1)
            new[own] = np.arange(len(own))
            inside = (new[u] >= 0) & (new[v] >= 0)
            part[own[_bisect(len(own), new[u[inside]], new[v[inside]])]] += count
        count *= 2
    return part, u, v


class Router:
    """One hidden layer, softmax over the parts."""

    def __init__(self, weights: list[np.ndarray], parts: int) -> None:
        self.weights, self.parts = weights, parts

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.ones((len(x), 1))
        a, b, c, d = self.weights
        z = np.maximum(x @ a + b, 0) @ c + d
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def visits(self, x: np.ndarray, level: float, rows: np.ndarray, need: int) -> list[list[int]]:
        """Most probable parts, until their probabilities add up to ``level`` and their ``rows`` to ``need`` (or all parts)."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
        held = np.cumsum(rows[order], 1) - rows[order]
        return [o[go].tolist() for o, go in zip(order, (before < level) | (held < need))]


def fit_router(x: np.ndarray, parts: int, hidden: int = 128, epochs: int = 15, rate: float = 2e-3) -> Router:
    """Learns the shares of each part among a vector and its graph neighbours (Adam, fixed seed)."""
    if parts == 1:
        return Router([], 1)
    part, u, v = balanced_parts(x, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (u, part[v]), 1.0)
    target[np.arange(len(x)), part] += 2.0
    target /= target.sum(1, keepdims=True)
    rng = np.random.default_rng(7)
    d = x.shape[1]
    scale = 1 / max(float(np.sqrt((x * x).mean())), 1e-12)
    w = [rng.normal(size=(d, hidden)) * scale / math.sqrt(d), np.zeros(hidden), rng.normal(size=(hidden, parts)) / math.sqrt(hidden), np.zeros(parts)]
    m, s, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), 256):
            at = order[k : k + 256]
            h = np.maximum(x[at] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            z = np.exp(z - z.max(1, keepdims=True))
            e = (z / z.sum(1, keepdims=True) - target[at]) / len(at)
            back = (e @ w[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((x[at].T @ back, back.sum(0), h.T @ e, e.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                step = (scale if i == 0 else 1.0) * rate
                w[i] = w[i] - step * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-9)
    return Router(w, parts)


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), d)


def nearest(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, distance) of the k nearest rows of a block to each query but itself; exact distances, ties to the smaller id."""
    square = (x * x).sum(1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries), 256):
        q, own = queries[a : a + 256], query_ids[a : a + 256]
        size = (q * q).sum(1)
        rough = np.maximum(size[:, None] + square[None] - 2 * q @ x.T, 0)
        rough[own[:, None] == ids[None]] = np.inf
        slack = 1e-9 * (size + square.max(initial=0))
        edge = (np.partition(rough, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(q), np.inf)) + slack
        i, j = np.nonzero((rough <= edge[:, None]) & np.isfinite(rough))
        for b in range(0, len(i), 1 << 16):
            r, c = i[b : b + (1 << 16)], j[b : b + (1 << 16)]
            out.append((own[r], ids[c], np.sqrt(((q[r] - x[c]) ** 2).sum(1))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    qi, ci, di = (np.concatenate(o) for o in zip(*out))
    order = np.lexsort((ci, di, qi))
    qi, ci, di = qi[order], ci[order], di[order]
    first = np.maximum.accumulate(np.where(np.concatenate(([True], qi[1:] != qi[:-1])), np.arange(len(qi)), 0)) if len(qi) else qi
    keep = np.arange(len(qi)) - first < k
    return qi[keep], ci[keep], di[keep]


FOUND = "query_id long, vec_id long, score double, part int"


def _found(q, i, d, part) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.float64()), pa.array(part, pa.int32())], names=["query_id", "vec_id", "score", "part"])


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def usable(table: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, v: the doubles' bytes in the shared folder) of the rows that take part, and their length."""
    v = F.col("v")
    ok = F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda a: a.isNull() | F.isnan(a) | (F.abs(a) == float("inf"))) & F.exists(v, lambda a: a != 0)
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(ok)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = usual["d"] if usual else 1
    rows = rows.where(F.size("v") == d).groupBy("vec_id").agg(F.min("v").alias("v"))

    def pack(batches):
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in flat], pa.binary())], names=["vec_id", "v"])

    return materialise(rows.mapInArrow(pack, "vec_id long, v binary"), "ann-vectors"), d


def _sample(rows: DataFrame, total: int, most: int) -> DataFrame:
    """The ``most`` rows of smallest id hashes. A bound on the hash leaves some twice as many to sort, from however many partitions."""
    bound = int(min(2 * most + 1000, total) / max(total, 1) * 2.0**64) - 2**63 - 1
    near = rows if total <= 2 * most + 1000 else rows.where(F.xxhash64("vec_id") <= F.lit(bound))
    return near.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most)


def search(table: DataFrame, is_query: Column, k: int = 10, recall: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each row for which ``is_query`` (an expression of vec_id) holds."""
    rows, d = usable(table, vec_id, vector)
    total = rows.count()
    parts = 1 << max(0, min(int(math.log2(PARTS)), round(math.log2(max(total, 1) / PART_ROWS))))
    sample = _sample(rows, total, SAMPLE + CALIBRATION).toPandas()
    x = np.frombuffer(b"".join(map(bytes, sample["v"])), np.float64).reshape(len(sample), d)
    fitted = len(sample) - min(CALIBRATION, len(sample) // 8)
    router = fit_router(x[:fitted], parts)

    def assign(batches):
        for b in batches:
            v = _vectors(b.column(1), d)
            part = router.probabilities(v).argmax(1) if len(v) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(part, pa.int32())], names=["vec_id", "v", "part"])

    indexed = materialise(rows.mapInArrow(assign, "vec_id long, v binary, part int"), "ann-index")
    level = _level(indexed, router, x[fitted:], sample["vec_id"].to_numpy(np.int64)[fitted:], k, d, recall)
    held = np.zeros(parts, np.int64)
    for r in indexed.groupBy("part").count().collect():  # at most PARTS rows
        held[r["part"]] = r["count"]

    def route(batches):
        for b in batches:
            visits = router.visits(_vectors(b.column(1), d), level, held, k + 1) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(visits, pa.list_(pa.int32()))], names=["vec_id", "v", "parts"])

    asked = indexed.where(is_query).select("vec_id", "v").mapInArrow(route, "vec_id long, v binary, parts array<int>")
    asked = asked.select("vec_id", "v", F.explode("parts").alias("part"))
    # At most PARTS rows each: how many blocks of rows and of queries a part has.
    sizes = indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    calls = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("turns"))
    plan = F.broadcast(sizes.join(calls, "part"))
    deal = lambda name: F.pmod(F.xxhash64("vec_id"), F.col(name)).cast("int")
    left = asked.join(plan, "part").select("vec_id", "v", "part", deal("turns").alias("turn"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = indexed.join(plan, "part").select("vec_id", "v", "part", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), deal("blocks").alias("block"))

    def meet(key, a: pa.Table, b: pa.Table):
        names = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("part", pa.int32())])
        if not a.num_rows or not b.num_rows:
            return names.empty_table()
        va, vb = _vectors(a.column("v"), d), _vectors(b.column("v"), d)
        q, i, dist = nearest(va, a.column("vec_id").to_numpy(), vb, b.column("vec_id").to_numpy(), k)
        return pa.Table.from_batches([_found(q, i, dist, np.full(len(q), key[0].as_py()))])

    keys = ("part", "turn", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, FOUND)
    return _top(found, k).select("query_id", "rank", "vec_id", "score")


def _level(indexed: DataFrame, router: Router, x: np.ndarray, ids: np.ndarray, k: int, d: int, recall: float) -> float:
    """Smallest summed probability at which the calibration queries find ``recall`` of their true neighbours."""
    if router.parts == 1 or not len(x):
        return 1.0

    def scan(batches):
        for b in batches:
            if b.num_rows:
                part = b.column(2).to_numpy()
                own = b.column(0).to_numpy()
                q, i, dist = nearest(x, ids, _vectors(b.column(1), d), own, k)
                order = np.argsort(own, kind="stable")
                yield _found(q, i, dist, part[order[np.searchsorted(own[order], i)]])

    true = _top(indexed.mapInArrow(scan, FOUND), k).toPandas()
    p = router.probabilities(x)
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
    at = np.searchsorted(np.sort(ids), true["query_id"])
    row = np.argsort(ids, kind="stable")[at]
    place = np.argmax(order[row] == true["part"].to_numpy()[:, None], axis=1)
    needed = np.sort(before[row, place])  # a neighbour is met when the level exceeds what its part comes after
    if not len(needed):
        return 1.0
    return float(np.nextafter(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)], 2.0))
