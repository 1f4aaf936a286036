"""Exact top-k neighbours by inner product as a block matrix join.

Queries and candidates are dealt to blocks of bounded size, and every pair of
a query block and a candidate block is one task's work. A tile of int8
products with a bound of the quantisation error gives every pair a lower and
an upper limit; only pairs whose upper limit reaches the k-th best lower one
are computed again in double precision. Heaps keep the best of each block,
and the lists of all blocks are merged by rank.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CANDIDATE_FLOATS, QUERY_FLOATS = 1 << 20, 1 << 22  # of a block
SAFE = 1e-140, 1e140  # largest components for which squares neither vanish nor overflow
TILE = 512, 4096  # queries and candidates of a product tile


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors and of what they miss.
    Vectors whose squares would vanish or overflow miss without bound: their
    pairs are all computed in double precision."""
    most = np.abs(x).max(axis=1)
    wild = (most < SAFE[0]) | (most > SAFE[1])
    scale = np.where(wild, 1.0, most / 127)
    tame = np.where(wild[:, None], 0.0, x)
    code = np.clip(np.rint(tame / scale[:, None]), -127, 127).astype(np.int8)
    back = code * scale[:, None]
    return code, scale, np.linalg.norm(back, axis=1), np.where(wild, np.inf, np.linalg.norm(tame - back, axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products in double precision, summed left to right;
    one that overflows both ways, which is no number, ranks last."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(a.shape[1]):
            total += a[:, d] * b[:, d]
    return np.where(np.isnan(total), -np.inf, total)


def distinct_rows(ids: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors the ``keep`` smallest ids: no others can be among a
    query's ``keep - 1`` nearest, as equal vectors tie and small ids go first."""
    order = np.lexsort((ids, np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * 8}").ravel(), return_inverse=True)[1]))
    ids, x = ids[order], x[order]
    new = np.append(True, (x[1:] != x[:-1]).any(axis=1))
    repeat = np.append(False, (ids[1:] == ids[:-1]) & ~new[1:])  # the same row once more
    ids, x, new = ids[~repeat], x[~repeat], new[~repeat]
    first = np.flatnonzero(new)
    rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    return ids[rank < keep], x[rank < keep]


def block_top(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, product): the k best of the block for each query."""
    c_ids, c = distinct_rows(c_ids, c, k + 1)
    q_ids, q = distinct_rows(q_ids, q, len(q_ids))
    exact = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    qc, qs, qn, qe = quantised(q)
    cc, cs, cn, ce = quantised(c)
    # |<x, y> - <x', y'>| <= |x - x'| |y| + |x'| |y - y'|, and a little for rounding
    size = np.where(np.isinf(ce), 1.0, np.linalg.norm(np.where(np.isinf(ce)[:, None], 0.0, c), axis=1))
    cf = cc.astype(exact).T
    out = []
    for s in range(0, len(q), TILE[0]):
        rows = slice(s, min(s + TILE[0], len(q)))
        n = rows.stop - rows.start
        best = np.full(n, -np.inf)
        kept = []
        qf = qc[rows].astype(exact)
        for t in range(0, len(c), TILE[1]):
            cols = slice(t, min(t + TILE[1], len(c)))
            near = (qf @ cf[:, cols]).astype(np.float64) * qs[rows, None] * cs[cols]
            with np.errstate(invalid="ignore"):
                slack = (qe[rows, None] * size[cols] + qn[rows, None] * ce[cols]) * (1 + 1e-9) + 1e-12 * (np.abs(near) + 1)
            slack[np.isinf(qe[rows])] = np.inf
            slack[:, np.isinf(ce[cols])] = np.inf
            near[q_ids[rows, None] == c_ids[None, cols]] = -np.inf
            low = near - slack
            if low.shape[1] > k:
                best = np.maximum(best, np.partition(low, -k, axis=1)[:, -k])
            i, j = np.nonzero((near > -np.inf) & (np.where(near > -np.inf, near, 0) + slack >= best[:, None]))
            kept.append((i, j + t, (near[i, j] + slack[i, j])))
        i, j, high = (np.concatenate(x) for x in zip(*kept)) if kept else (np.zeros(0, int),) * 3
        alive = high >= best[i]
        i, j = i[alive], j[alive]
        score = np.concatenate([products(q[rows][i[a:a + 65536]], c[j[a:a + 65536]]) for a in range(0, len(i), 65536)] or [np.zeros(0)])
        order = np.argsort(i, kind="stable")
        i, j, score = i[order], j[order], score[order]
        cuts = np.searchsorted(i, np.arange(n + 1))
        for r in range(n):
            a, b = cuts[r], cuts[r + 1]
            heap = heapq.nsmallest(k, zip((-score[a:b]).tolist(), c_ids[j[a:b]].tolist()))
            out += [(int(q_ids[rows.start + r]), v, -x) for x, v in heap]
    return out


def vectors(column: pa.ChunkedArray, ids: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix by dimension."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    if not len(lists):
        return {}
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(size) - size
    ids = ids.to_numpy()
    return {int(d): (ids[size == d], flat[start[size == d][:, None] + np.arange(d)]) for d in np.unique(size)}


def nearest(frame: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of every query row (condition ``is_query``) by
    inner product: query_id long, rank int from 1, vec_id long, score double.

    Nearest first, ties to the smaller id. A row is not its own candidate.
    Rows take no part if id or vector is null, the vector is empty or zero or
    holds a null or a non-finite number. Vectors of another dimension are no
    candidates. An exactly repeated row counts once. Products that overflow
    are infinite, and -infinite if they overflow both ways. With fewer than ``k``
    candidates all are returned; no query, no rows. Other columns are ignored.
    """
    x = F.col("v")
    good = (frame.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("v"), is_query.alias("q"))
            .filter(F.col("id").isNotNull() & x.isNotNull()
                    & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
                    & F.exists(x, lambda e: e != 0))
            .groupBy("id", "v").agg(F.max("q").alias("q")))  # exact repeats go before anything is dealt
    n = good.agg(F.count("*").alias("n"), F.count_if("q").alias("q"), F.max(F.size("v")).alias("d")).first()
    dim = n["d"] or 1
    q_blocks = max(1, -(-n["q"] * dim // QUERY_FLOATS))
    c_blocks = max(1, -(-n["n"] * dim // CANDIDATE_FLOATS))
    deal = lambda blocks: F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = good.filter("q").select("id", "v", deal(q_blocks).alias("qb")).withColumn("cb", every(c_blocks))
    candidates = good.select("id", "v", deal(c_blocks).alias("cb")).withColumn("qb", every(q_blocks))
    out = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(out)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        mine, theirs = vectors(left["v"], left["id"]), vectors(right["v"], right["id"])
        rows = [r for d in mine if d in theirs for r in block_top(*mine[d], *theirs[d], k)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else ([], [], []), schema)], schema=schema)

    lists = queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInArrow(join, out)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
