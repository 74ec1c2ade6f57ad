"""Exact nearest neighbours by inner product through a block matrix join.

Queries and candidates are dealt to a grid of cells, so that each query meets each candidate in one cell. In a cell,
products of int8 codes give every inner product within a known error; only pairs that could still be among the best
are computed in double precision from the original vectors, and go through a heap per query. The cells' best are
merged at the end. Nothing is approximate in the result: the error bound proves that no neighbour is lost.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
TILE = 1024
RESULT = "query_id long, vec_id long, score double"


def usable_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of rows that take part; of rows with one id, the least vector."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), x.alias("embedding"))
    return (
        rows.where(F.col("vec_id").isNotNull())
        .where(~F.coalesce(bad, F.lit(True)))
        .where(F.exists("embedding", lambda e: e != 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = table.column("embedding").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return table.column("vec_id").to_numpy(), flat.reshape(table.num_rows, -1)


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scale, the norm of what they stand for, and the norm of what they leave out."""
    scale = np.maximum(np.abs(x).max(axis=1, keepdims=True) / 127, 1e-300)
    codes = np.rint(x / scale).astype(np.int8)
    coded = codes * scale
    return codes, scale[:, 0], np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def search_cell(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The best ``k`` candidates of each query in one cell."""
    # Sums of int8 products are whole numbers below 2**24 for up to 1,040 dimensions, so float32 holds them exactly.
    kind = np.float32 if q.shape[1] <= 1040 else np.float64
    q_codes, q_scale, q_norm, q_rest = _codes(q)
    q_codes = q_codes.astype(kind)
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    least = np.full(len(q_ids), -np.inf)  # what a candidate must reach to count
    for at in range(0, len(c_ids), TILE):
        ids, part = c_ids[at : at + TILE], c[at : at + TILE]
        codes, scale, norm, rest = _codes(part)
        near = (q_codes @ codes.astype(kind).T).astype(np.float64) * q_scale[:, None] * scale[None, :]
        # |xy - x'y'| <= |x'||y - y'| + |x - x'|(|y'| + |y - y'|), and a little for rounding.
        error = (q_norm[:, None] * rest + q_rest[:, None] * (norm + rest)) * (1 + 1e-9) + 1e-12 * (q_norm[:, None] * norm + 1e-300)
        own = q_ids[:, None] == ids[None, :]
        low = np.where(own, -np.inf, near - error)
        if low.shape[1] > k:
            least = np.fmax(least, -np.partition(-low, k - 1, axis=1)[:, k - 1])
        rows, cols = np.nonzero(~(near + error < least[:, None]) & ~own)  # an overflow stays in
        exact = np.zeros(len(rows))
        for d in range(q.shape[1]):  # one component after another: the sum's order is fixed
            exact += q[rows, d] * part[cols, d]
        for r, i, s in zip(rows.tolist(), ids[cols].tolist(), exact.tolist(), strict=True):
            heap = heaps[r]
            if len(heap) < k:
                heapq.heappush(heap, (s, -i))
            elif (s, -i) > heap[0]:
                heapq.heapreplace(heap, (s, -i))
        full = [heap[0][0] if len(heap) == k else -math.inf for heap in heaps]
        least = np.fmax(least, full)
    return [(int(q_ids[r]), -i, s) for r, heap in enumerate(heaps) for s, i in heap]


def nearest_neighbours(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of largest inner product for each query, all if fewer.

    Both frames come from ``usable_vectors``. A candidate with the query's own id takes no part, nor does one of another
    number of dimensions. Of equal scores the smaller ``vec_id`` is nearer. Without candidates a query has no rows.
    """
    n_queries, n_candidates = queries.count(), candidates.count()
    grid = max(1, math.ceil(n_queries / QUERY_BLOCK)), max(1, math.ceil(n_candidates / CANDIDATE_BLOCK))
    numbered = F.hash("vec_id", F.lit("cell"))
    dims = F.size("embedding").alias("dims")
    left = queries.select(
        "vec_id", "embedding", dims, F.pmod(numbered, F.lit(grid[0])).alias("r"),
        F.explode(F.sequence(F.lit(0), F.lit(grid[1] - 1))).alias("c"),
    )
    right = candidates.select(
        "vec_id", "embedding", dims, F.explode(F.sequence(F.lit(0), F.lit(grid[0] - 1))).alias("r"),
        F.pmod(numbered, F.lit(grid[1])).alias("c"),
    )

    def cell(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        found = search_cell(*_matrix(a), *_matrix(b), k) if a.num_rows and b.num_rows else []
        columns = zip(*found, strict=True) if found else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(list(x), t) for n, x, t in zip(("query_id", "vec_id", "score"), columns, kinds, strict=True)})

    best = left.groupBy("dims", "r", "c").cogroup(right.groupBy("dims", "r", "c")).applyInArrow(cell, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
