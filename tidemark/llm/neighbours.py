"""Approximate nearest neighbours by collision-counting hashing (query-aware windows).

Every vector is projected on ``projections`` random lines; a block of vectors keeps each projection as
a sorted array. A query opens a window around its own projection on every line and widens all windows
together by virtual rehashing (radius ``R`` times ``growth`` per round; half width ``width * R / 2``). Each
vector newly reached by a window counts one collision; at ``threshold`` collisions it is verified by its
exact distance. A query stops in a block once ``k`` verified vectors lie within ``R``. With the defaults a
vector at distance R has collided on a line with probability 0.68 and is verified at 0.6 of the lines.

Blocks hold at most ``block_rows`` vectors dealt evenly whatever their ids; queries meet every block in
chunks of ``query_rows``, each block returns its ``k`` best per query, and the best of those are kept.
The grid of radii per block starts at a fraction of its mean projected spread; nothing is sampled.

Defined results: vectors that are null, zero, empty or hold null or non-finite components take no part;
vectors of another length than the query's are no candidates; rows with the query's own id are its own
row; a repeated query row asks once; fewer than ``k`` candidates are all returned; ties go to the
smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding array<double>`` of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & F.exists("embedding", lambda x: x != 0))


def _matrix(t: pa.Table) -> np.ndarray:
    flat = t.column("embedding").combine_chunks()
    values = (flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(t.num_rows, -1)


def _reached(order: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Positions ``base[q] + order[i]`` for all i in [lo[q], hi[q])."""
    n = hi - lo
    if not n.sum():
        return np.zeros(0, np.int64)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return np.repeat(base, n) + order[at]


class Best:
    """The ``k`` nearest verified vectors of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.queries = k, queries
        self.q, self.id, self.d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.worst = np.full(queries, np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        near = d <= self.worst[q]
        q, ids, d = (np.concatenate(x) for x in ((self.q, q[near]), (self.id, ids[near]), (self.d, d[near])))
        order = np.lexsort((ids, d, q))
        q, ids, d = q[order], ids[order], d[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        self.q, self.id, self.d = q[keep], ids[keep], d[keep]
        full = rank == self.k - 1
        self.worst[q[full]] = d[full]


def search_block(q_ids, q, ids, x, k, projections=24, threshold=0.6, width=2.0, growth=1.5, seed=7, chunk=128):
    """Best ``k`` of a block for every query, as arrays (query id, vector id, distance)."""
    lines = np.random.default_rng(seed).standard_normal((x.shape[1], projections))
    px, pq = x @ lines, q @ lines
    order = np.argsort(px, axis=0, kind="stable")
    ranked = np.take_along_axis(px, order, axis=0)
    need = math.ceil(threshold * projections)
    first = max(1e-12, float(np.sqrt(((px - px.mean(axis=0)) ** 2).mean()))) / 4
    n, out = len(ids), []
    for a in range(0, len(q), chunk):
        part = np.arange(a, min(len(q), a + chunk))
        count = np.zeros(len(part) * n, np.int16)
        best = Best(len(part), k)
        lo = np.stack([np.searchsorted(ranked[:, j], pq[part, j]) for j in range(projections)])
        hi = lo.copy()
        live, radius = np.arange(len(part)), first
        while len(live):
            fresh = []
            for j in range(projections):
                c = pq[part[live], j]
                new_lo = np.minimum(np.searchsorted(ranked[:, j], c - width * radius / 2, "left"), lo[j, live])
                new_hi = np.maximum(np.searchsorted(ranked[:, j], c + width * radius / 2, "right"), hi[j, live])
                fresh += [_reached(order[:, j], new_lo, lo[j, live], live * n), _reached(order[:, j], hi[j, live], new_hi, live * n)]
                lo[j, live], hi[j, live] = new_lo, new_hi
            hits = np.concatenate(fresh)
            more = np.bincount(hits, minlength=len(count)).astype(np.int16)
            crossed = np.flatnonzero((count < need) & (count + more >= need))
            count += more
            for b in range(0, len(crossed), 65536):
                qi, vi = np.divmod(crossed[b : b + 65536], n)
                other = ids[vi] != q_ids[part[qi]]
                qi, vi = qi[other], vi[other]
                best.add(qi, ids[vi], np.sqrt(((q[part[qi]] - x[vi]) ** 2).sum(axis=1)))
            whole = ((lo[:, live] == 0) & (hi[:, live] == n)).all(axis=0)
            live = live[~(whole | (best.worst[live] <= radius))]
            radius *= growth
        out.append((q_ids[part[best.q]], best.id, best.d))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, t) for t in (np.int64, np.int64, np.float64)]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = 65536, query_rows: int = 8192, min_blocks: int = 64, **settings) -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean distance) for each row of ``queries``."""
    base = cut(usable(vectors))
    n = base.count()
    rows = min(block_rows, max(256, math.ceil(n / min_blocks)))
    blocks = max(1, math.ceil(n / rows))
    ask = cut(usable(queries).dropDuplicates(["vec_id", "embedding"]))
    chunks = max(1, math.ceil(ask.count() / query_rows))
    data = cut(base.repartition(blocks).withColumn("block", F.spark_partition_id()))
    data = data.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    ask = ask.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(chunks)).cast("int"))
    ask = ask.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dims = F.size("embedding").alias("dims")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if left.num_rows and right.num_rows:
            cols = search_block(left.column("vec_id").to_numpy(), _matrix(left), right.column("vec_id").to_numpy(), _matrix(right), k, **settings)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, cols))))

    by = ["block", "chunk", "dims"]
    found = ask.select("*", dims).groupBy(*by).cogroup(data.select("*", dims).groupBy(*by)).applyInArrow(run, FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
