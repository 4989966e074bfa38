"""Exact top-k inner products by Fagin's threshold algorithm.

Every block of candidates keeps one list of its vectors for each dimension, sorted by that component. Sorted access goes down
all lists in step, from both ends (the end depends on the sign of the query's component); each vector that turns up is scored
in full. The bound is the best score of a vector that has not turned up, put together from the last components read. A query
stops when its bound is below its k-th score: then no unseen vector can enter, ties included.

Queries and candidates meet block by block; equal vectors are first merged to their k + 1 smallest ids, which loses nothing.

Cases: vectors that are null or hold null or non-finite components take no part; vectors of different length are not compared;
k is not reached if there are fewer candidates; ties go to the smaller id; rows of equal id and vector count once;
rows with a null id take no part; other columns play no part. Components beyond 2^31 after scaling are not supported and raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192  # vectors of a block


def best_of_block(q: np.ndarray, c: np.ndarray, ids: list[np.ndarray], own: np.ndarray, k: int):
    """For each row of q the k best (score, id) among the vectors of c. ids: the ids that share a vector, ascending."""
    n, dim = c.shape
    exact = n and dim and float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * dim < 2**53
    kind = np.float64 if exact or not dim else object
    q, c = q.astype(kind), c.astype(kind)
    order = np.argsort(c, axis=0, kind="stable")
    rank = np.empty((n, dim), dtype=np.int64)
    for d in range(dim):
        rank[order[:, d], d] = np.arange(n)
    depth = np.minimum(rank, n - 1 - rank).min(axis=1) if dim else np.zeros(n, dtype=np.int64)
    by_depth = np.argsort(depth, kind="stable")
    lists = np.take_along_axis(c, order, axis=0)
    first = np.array([x[0] for x in ids], dtype=np.int64)
    best: list[list[tuple]] = [[] for _ in range(len(q))]
    active, seen, reach = np.arange(len(q)), 0, min(n, max(64, n // 16))
    while len(active) and seen < n:
        stop = int(np.searchsorted(depth[by_depth], reach, side="left"))
        new = by_depth[seen:stop]
        scores = q[active] @ c[new].T if dim else np.zeros((len(active), len(new)))
        for row, a in enumerate(active):
            s = scores[row]
            if len(s) > k + 1:  # the query's own vector may be among them; all ties of the last place stay
                s_cut = np.partition(s, len(s) - k - 1)[len(s) - k - 1] if kind is np.float64 else np.sort(s)[len(s) - k - 1]
                if len(best[a]) == k:
                    s_cut = max(s_cut, best[a][-1][0])
                at = np.flatnonzero(s >= s_cut)
                if len(at) > 4 * k:  # many ties: the smallest ids suffice
                    at = at[np.lexsort((first[new[at]], -s[at].astype(np.float64)))[: k + 1]]
            else:
                at = np.arange(len(s))
            found = [(s[j], i) for j in at for i in ids[new[j]] if i != own[a]]
            best[a] = sorted(best[a] + found, key=lambda x: (-x[0], x[1]))[:k]
        seen = stop
        if seen < n and dim:
            low, high = lists[min(reach, n) - 1], lists[n - min(reach, n)]
            bound = np.maximum(q[active], 0) @ high + np.minimum(q[active], 0) @ low
            active = np.array([a for a, b in zip(active, bound) if len(best[a]) < k or b >= best[a][-1][0]], dtype=np.int64)
        reach = min(n, reach * 2)
    return best


def _search(k: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        flat = lambda t: np.asarray(t["v"].combine_chunks().flatten(), dtype=np.int64).reshape(t.num_rows, -1)
        own = np.asarray(left["id"])
        ids = [np.sort(np.array(x, dtype=np.int64)) for x in right["ids"].to_pylist()]
        best = best_of_block(flat(left), flat(right), ids, own, k)
        rows = [(int(o), int(i), int(s)) for o, b in zip(own, best) for s, i in b]
        return pa.Table.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3, schema=schema)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score. Components become floor(scale * x)."""
    v = F.col(f"`{vec_col}`")
    fine = F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(scale)))
    checked = F.when(F.exists(whole, lambda x: F.abs(x) > 2**31), F.raise_error(F.lit("a component is too large"))).otherwise(whole)
    rows = vectors.filter(fine).select(F.col(f"`{id_col}`").cast("long").alias("id"), checked.alias("v"), is_query.alias("asks")).distinct()
    # equal vectors: a query needs at most k of them, or k + 1 with itself
    same = Window.partitionBy("v").orderBy("id")
    few = rows.select("v", "id").withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)
    merged = few.groupBy("v").agg(F.collect_list("id").alias("ids"))
    n = rows.agg(F.count("*").alias("all"), F.count(F.when(F.col("asks"), 1)).alias("asks")).first()
    qb, cb = max(1, -(-n["asks"] // QUERY_BLOCK)), max(1, -(-n["all"] // CANDIDATE_BLOCK))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    asks = rows.filter("asks").select(F.pmod(F.xxhash64("id"), F.lit(qb)).cast("int").alias("q"), every(cb).alias("c"), F.size("v").alias("dim"), "id", "v")
    pool = merged.select(every(qb).alias("q"), F.pmod(F.xxhash64("v"), F.lit(cb)).cast("int").alias("c"), F.size("v").alias("dim"), "ids", "v")
    found = asks.groupBy("q", "c", "dim").cogroup(pool.groupBy("q", "c", "dim")).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
