"""Nearest neighbours by inner product as a block matrix join.

Queries and candidates are dealt into a grid of blocks; each cell of the grid multiplies one query block
with one candidate block in int8. A quantised vector differs from the real one by at most half a step in
each component, which bounds the error of every product; a pair survives if its upper bound reaches the
k-th best lower bound of its query. Survivors are recomputed from the original vectors in double
precision, and per-query heaps of k are merged over cells. The bounds make the result exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CANDIDATES, QUERIES = 8192, 2048


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 values and the step of each row: |x - q * step| <= step / 2 in each component."""
    step = np.abs(x).max(1) / 127
    step[step == 0] = 1
    return np.rint(x / step[:, None]).astype(np.int8), step


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double, summed in component order, so equal rows give equal products."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * c[:, d]
    return out


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by a power of two that brings their largest component under 1, and its exponent: bounds never overflow."""
    e = np.frexp(np.abs(x).max(1))[1]
    return np.ldexp(x, -e[:, None]), e


def search_cell(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, tile: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best candidates of a cell; a score that isn't a number counts as the largest."""
    (qx, qe), (cx, ce) = scaled(q), scaled(c)
    q8, qs = quantise(qx)
    c8, cs = quantise(cx)
    # products of a query are compared in units of its own power of two times the candidates' largest one
    unit = np.ldexp(1.0, np.maximum(ce - ce.max(), -1074))
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64  # int8 products are exact in it
    cf = c8.astype(kind)
    q1, c1 = np.abs(qx).sum(1), np.abs(c8.astype(np.int64)).sum(1) * cs
    room_for_sums = 1020 - int(np.ceil(np.log2(q.shape[1])))
    found = []
    for a in range(0, len(q), tile):
        rows = slice(a, a + tile)
        approx = (q8[rows].astype(kind) @ cf.T).astype(np.float64) * qs[rows, None] * (cs * unit)[None, :]
        # |q.c - q'.c'| <= |q|1 * cs/2 + |c'|1 * qs/2, with room for rounding
        room = (q1[rows, None] * (cs * unit / 2)[None, :] + (c1 * unit)[None, :] * (qs[rows, None] / 2)) * (1 + 1e-9) + 1e-300
        own = qid[rows, None] == cid[None, :]
        low = np.where(own, -np.inf, approx - room)
        bar = np.partition(low, -k, axis=1)[:, -k] if len(cid) > k else np.full(len(low), -np.inf)
        # sums that may leave the range of doubles, or that are rounded below it, have no bound: they are always recomputed
        size = qe[rows, None] + ce[None, :]
        i, j = np.nonzero(((approx + room >= bar[:, None]) | (size > room_for_sums) | (size < -900)) & ~own)
        with np.errstate(over="ignore", invalid="ignore"):
            score = exact_products(q[a + i], c[j])
        order = np.lexsort((cid[j], -score, ~np.isnan(score), i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < k
        found.append((qid[a + i[top]], cid[j[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merge_heaps(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(query_id, rank, vec_id, score) from (query_id, vec_id, score) of all cells: a heap of the k best of each query."""
    heaps: dict[int, list[tuple]] = {}
    for batch in batches:
        for query, vec, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            heap, item = heaps.setdefault(query, []), (score != score, 0.0 if score != score else score, -vec)
            if len(heap) < k:
                heapq.heappush(heap, item)
            else:
                heapq.heappushpop(heap, item)
    rows = [(q, r, -vec, float("nan") if bad else score) for q, heap in heaps.items() for r, (bad, score, vec) in enumerate(sorted(heap, reverse=True), 1)]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    cols = list(zip(*rows, strict=True)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["query_id", "rank", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows by inner product, ties to the smaller id.

    Null, empty and zero vectors, vectors with null or non-finite components and null ids take no part;
    vectors of another length than the query's are no candidates for it. Rows that repeat an id are
    candidates each (in order of their id), and none of them for a query of that id. Fewer candidates than
    k give fewer rows; empty tables give none. Only the id and vector columns are read.
    """

    def clean(df: DataFrame, salt: int) -> DataFrame:
        v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and size(v) > 0")
        ok = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
        return v.where(ok).withColumn("dim", F.size("v")).withColumn("h", F.xxhash64(F.lit(salt), "id"))

    c, q = clean(vectors, 1), clean(queries, 2)
    rows = max(1, -(-c.count() // CANDIDATES))
    cols = max(1, -(-q.count() // QUERIES))
    # each candidate block meets each query block once: the stated queries against all rows, in blocks
    c = c.withColumn("row", F.pmod("h", F.lit(rows)).cast("int")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1)))).drop("h")
    q = q.withColumn("col", F.pmod("h", F.lit(cols)).cast("int")).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).drop("h")
    cell = ["dim", "row", "col"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        a, b, s = search_cell(left["id"].to_numpy(), np.stack(left["v"]), right["id"].to_numpy(), np.stack(right["v"]), k)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    part = q.groupBy(*cell).cogroup(c.groupBy(*cell)).applyInPandas(run, "query_id long, vec_id long, score double")
    # a task holds k rows for each of its queries
    return part.repartition("query_id").mapInArrow(lambda batches: merge_heaps(batches, k), "query_id long, rank int, vec_id long, score double")


def op5_ann(spark, sf_dir: str) -> DataFrame:
    """Each vector whose id is divisible by 20 against all vectors: its 20 nearest by inner product."""
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(v, v.where("vec_id % 20 = 0"), 20)
