"""Exact top-k by inner product with a KD-tree for each shard.

Vectors are dealt to shards by hash. A tree halves its points at the median of the
widest side of their box and keeps a tight box for every node; the largest
inner product a query can have inside a box bounds what the node may hold. Nodes are visited
best bound first until none can beat the k-th score. A query is searched in one shard first;
its k-th score there goes with it to all other shards, where it ends most searches early.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skygrain.llm.common import rows_for
from skygrain.session import durable

SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 8192, 4096, 128
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or holds a null or non-finite one."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class Tree:
    """Points in tree order, and of each node its range of points, box, smallest id and children."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.argsort(ids, kind="stable")
        self.first, self.last, self.low, self.high, self.least, self.children = [], [], [], [], [], []
        pending = [(0, len(ids), -1)]
        while pending:
            a, b, parent = pending.pop()
            some = points[order[a:b]]
            low, high = some.min(axis=0, initial=_LONG), some.max(axis=0, initial=-_LONG)
            node = len(self.first)
            for column, value in zip((self.first, self.last, self.low, self.high, self.least, self.children),
                                     (a, b, low, high, ids[order[a:b]].min(), [])):
                column.append(value)
            if parent >= 0:
                self.children[parent].append(node)
            spread = high.astype(float) - low.astype(float)
            if b - a > leaf and spread.size and spread.max() > 0:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(some[:, spread.argmax()], middle)]
                pending += [(a, a + middle, node), (a + middle, b, node)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with a point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, kth: float | None) -> list[tuple[int, int]]:
        """(score, id) of the k best points but those with the query's id, among points that score ``kth`` or more."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id), worst first
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if kth is not None and -bound < kth:
                break
            if len(best) == k and (-bound, -self.least[node]) < best[0]:
                continue
            if self.children[node]:
                for child in self.children[node]:
                    if kth is None or bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            a, b = self.first[node], self.last[node]
            scores = self.points[a:b] @ query
            good = np.ones(b - a, bool) if kth is None else scores >= kth
            good &= self.ids[a:b] != own
            at = np.flatnonzero(good)
            if len(at) > k:
                at = at[np.lexsort((self.ids[a:b][at], -scores[at]))[:k]]
            for i in at:
                entry = (int(scores[i]), -int(self.ids[a + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                kth = best[0][0]
        return [(score, -i) for score, i in sorted(best, reverse=True)]


def _numbers(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in vectors])


def _search(points: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best points of one shard for some queries; only vectors of the same length are compared."""
    rows = []
    points, queries = points.assign(dim=points["v"].map(len)), queries.assign(dim=queries["v"].map(len))
    for dim, some in queries.groupby("dim"):
        mine = points[points["dim"] == dim]
        if not len(mine):
            continue
        x, q = _numbers(mine["v"]), _numbers(some["v"])
        exact = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * max(dim, 1) < _EXACT
        x, q = (x.astype(float), q.astype(float)) if exact else (x.astype(object), q.astype(object))
        tree = Tree(mine["vec_id"].to_numpy(np.int64), x)
        bounds = tree.bounds(q)
        for query, own, row, kth in zip(q, some["query_id"].to_numpy(np.int64), bounds, some["kth"]):
            for score, i in tree.search(query, int(own), row, k, None if pd.isna(kth) else int(kth)):
                rows.append((own, i, max(-_LONG - 1, min(_LONG, score))))
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "vector") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best vectors, all if there are fewer.

    Vectors are arrays of integers. Ties go to the smaller id; points with the query's id are its own
    and left out. Null ids and vectors take no part. Rows that repeat an id are points of their own; a repeated
    query id asks once, with its smallest vector. Vectors of another length than the query's are not compared.
    Scores beyond 64 bits become the nearest long. Empty tables give an empty result; other columns are not read.
    """
    points = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).dropna()
    shards = rows_for(points.count(), SHARD_ROWS)
    points = durable(points.withColumn("shard", F.expr(f"cast(pmod(xxhash64(vec_id, v), {shards}) as int)")), "points")
    asked = (queries.select(F.col(key).cast("long").alias("query_id"), F.col(vector).alias("v")).dropna()
             .groupBy("query_id").agg(F.min("v").alias("v")).withColumn("home", F.expr(f"cast(pmod(xxhash64(query_id), {shards}) as int)")))
    asked = durable(asked, "asked")
    blocks = rows_for(asked.count(), BLOCK_QUERIES)
    schema = "query_id long, vec_id long, score long"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search(left, right, k)

    first = (points.groupBy("shard").cogroup(asked.withColumnRenamed("home", "shard").withColumn("kth", F.lit(None).cast("long")).groupBy("shard"))
             .applyInPandas(search, schema))
    first = durable(first, "first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).select("query_id", F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
    away = (asked.join(kth, "query_id", "left").withColumn("block", F.expr(f"cast(pmod(xxhash64(query_id, 1), {blocks}) as int)"))
            .withColumn("shard", F.explode(F.expr(f"filter(sequence(0, {shards - 1}), s -> s <> home)"))))
    copies = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    second = (copies.groupBy("shard", "block").cogroup(away.groupBy("shard", "block")).applyInPandas(search, schema))
    return _ranked(first.union(second), k).select("query_id", "rank", "vec_id", "score")
