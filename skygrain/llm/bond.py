"""Hard negatives by a vertical scan that shrinks a candidate bitmap (BOND).

Rows lie in blocks, one column of values for each dimension. An anchor reads the columns in the order of
its own components, largest magnitude first. After every few columns a candidate's score lies between
its partial sum plus the least and plus the greatest that the unread columns can add; both come
from the block's minimum and maximum of each column. Candidates that can no longer count leave the bitmap;
the scan goes on with the others until their scores are exact.

The anchors are a stated set: all of them meet all blocks, block by block. Positives need only blocks of the
anchor's label, so those are dealt by label, a large label to many blocks; negatives meet blocks dealt by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrain.llm.common import rows_for
from skygrain.session import durable

BLOCK_ROWS, BLOCK_ANCHORS = 8192, 2048
# Columns read between two looks at the bounds, and candidates from which on the rest is read at once.
COLUMNS, FEW = 8, 48
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


class Block:
    """Rows of one length, a column for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, largest: float):
        exact = largest * float(np.abs(rows.astype(float)).max(initial=0)) * max(rows.shape[1], 1) < _EXACT
        self.ids, self.labels, self.kind = ids, labels, float if exact else object
        self.columns = np.ascontiguousarray(rows.T).astype(self.kind)
        self.low, self.high = (self.columns.min(axis=1), self.columns.max(axis=1)) if rows.size else (np.zeros(rows.shape[1]),) * 2

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of the candidates that ``keep(least, greatest)`` never ruled out."""
        anchor = anchor.astype(self.kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        # what the columns from a position on can add at least and at most
        below = np.concatenate([np.cumsum(ends.min(axis=0)[::-1])[::-1], [0]])
        above = np.concatenate([np.cumsum(ends.max(axis=0)[::-1])[::-1], [0]])
        left = np.flatnonzero(bitmap)
        sums = np.zeros(len(left), self.kind)
        at = 0
        while at < len(order) and len(left):
            to = len(order) if len(left) <= FEW else min(at + COLUMNS, len(order))
            dims = order[at:to]
            # the whole column while most rows are left, else its candidates only
            part = anchor[dims] @ self.columns[dims] if len(left) == len(bitmap) else anchor[dims] @ self.columns[np.ix_(dims, left)]
            sums, at = sums + part, to
            good = keep(sums + below[at], sums + above[at])
            left, sums = left[good], sums[good]
        return left, sums


def _least_of_best(least: np.ndarray, k: int) -> float | None:
    """The k-th largest lower bound: what scores less is not among the best ``k``."""
    return np.partition(least, len(least) - k)[len(least) - k] if len(least) >= k else None


def best(block: Block, anchor: np.ndarray, bitmap: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(id, score) of the best ``k`` candidates."""
    def keep(least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        bound = _least_of_best(least, k)
        return np.ones(len(least), bool) if bound is None else greatest >= bound

    rows, scores = block.scan(anchor, bitmap, keep)
    return _first(block.ids[rows], scores, k)


def inside(block: Block, anchor: np.ndarray, bitmap: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """For each window of scores (both ends count) the best ``k`` candidates in it."""
    def keep(least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(least), bool)
        for low, high in windows:
            may = (greatest >= low) & (least <= high)
            bound = _least_of_best(least[(least >= low) & (greatest <= high)], k)
            wanted |= may if bound is None else may & (greatest >= bound)
        return wanted

    rows, scores = block.scan(anchor, bitmap, keep)
    out = []
    for low, high in windows:
        some = (scores >= low) & (scores <= high)
        out.append(_first(block.ids[rows[some]], scores[some], k))
    return out


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])) if scores.dtype == object else np.lexsort((ids, -scores))
    return [(int(ids[i]), int(scores[i])) for i in list(order)[:k]]


def _matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = lists.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), dim)


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _by_length(rows: pa.Table, anchors: pa.Table):
    """Blocks of rows of one length with the anchors of that length; vectors of different lengths have no product."""
    lengths, wanted = (pc.list_value_length(t.column("v")).to_numpy() for t in (rows, anchors))
    for dim in np.intersect1d(lengths, wanted).tolist():
        some, asked = rows.filter(pa.array(lengths == dim)), anchors.filter(pa.array(wanted == dim))
        vectors = _matrix(asked.column("v"), dim)
        block = Block(_ints(some, "vec_id"), _ints(some, "label"), _matrix(some.column("v"), dim), float(np.abs(vectors.astype(float)).max(initial=0)))
        yield block, asked, vectors


def _clip(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def _dealt(rows: DataFrame, anchors: DataFrame, run, schema: str, keys: list[str], blocks: int) -> DataFrame:
    """``run(rows, anchors)`` for every group of ``keys`` and block of anchors; the rows of a group meet each block."""
    rows = rows.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    anchors = anchors.withColumn("asked", F.expr(f"cast(pmod(xxhash64(anchor_id, 3), {blocks}) as int)"))
    return rows.groupBy(*keys, "asked").cogroup(anchors.groupBy(*keys, "asked")).applyInArrow(run, schema)


def positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """``anchor_id, positive_rank, positive_id, positive_score``: each anchor's best ``k`` rows of its own label."""
    sizes = rows.groupBy("label").count()
    large = durable(sizes.filter(F.col("count") > BLOCK_ROWS).select(F.col("label").alias("big"), F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("parts")), "labels")
    # a large label has blocks of its own; the others share blocks
    shared = rows_for(rows.count(), BLOCK_ROWS)
    slot = F.when(F.col("parts").isNull(), F.expr(f"pmod(xxhash64(label), {shared})")).otherwise(F.col("label"))
    parted = rows.join(large, F.col("label") == F.col("big"), "left").select(
        "vec_id", "label", "v", F.col("parts").isNotNull().alias("own"), slot.alias("slot"), F.expr("pmod(xxhash64(vec_id, v), coalesce(parts, 1))").alias("part"))
    asking = anchors.join(large, F.col("label") == F.col("big"), "left").select(
        "anchor_id", "label", "v", F.col("parts").isNotNull().alias("own"), slot.alias("slot"),
        F.explode(F.expr("transform(sequence(0, coalesce(parts, 1) - 1), p -> cast(p as bigint))")).alias("part"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block, asked, vectors in _by_length(left, right):
            for anchor, label, v in zip(_ints(asked, "anchor_id").tolist(), _ints(asked, "label").tolist(), vectors):
                bitmap = (block.labels == label) & (block.ids != anchor)
                out += [(anchor, i, _clip(score)) for i, score in best(block, v, bitmap, k)]
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    found = _dealt(parted, asking, run, "anchor_id long, positive_id long, positive_score long", ["own", "slot", "part"], rows_for(anchors.count(), BLOCK_ANCHORS))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("positive_rank", F.row_number().over(order)).filter(F.col("positive_rank") <= k).select("anchor_id", "positive_rank", "positive_id", "positive_score")


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "vector", positives_: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank`` of each anchor's hard negatives.

    ``vectors``: key and label (integers) and an array of integers; ``anchors`` says which rows ask. An anchor's positives are its best
    ``positives_`` other rows of its label by inner product; for each, its negatives are the best ``negatives`` rows of other labels whose
    score is ``low`` to ``high`` hundredths of the positive's. Ties go to the smaller key. Null keys, labels and vectors take no part.
    Rows that share a key are rows of their own, never answers for an anchor of that key; a key that asks more than once asks
    once, with its least label and then least vector. A row that is a positive twice has two ranks as such. Vectors of another length than
    the anchor's have no product with it. Scores beyond 64 bits become the nearest long. Empty tables, and anchors without
    a positive or a negative, give no rows; other columns are not read.
    """
    chosen = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"), anchors.alias("asks")).dropna(subset=["vec_id", "label", "v"])
    chosen = durable(chosen, "vectors")
    rows = chosen.select("vec_id", "label", "v")
    asking = chosen.filter("asks").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a"))
    asking = durable(asking.select(F.col("vec_id").alias("anchor_id"), "a.label", "a.v"), "anchors")
    near = durable(positives(rows, asking, positives_), "positives")

    shards, blocks = rows_for(rows.count(), BLOCK_ROWS), rows_for(asking.count(), BLOCK_ANCHORS)
    dealt = rows.withColumn("shard", F.expr(f"cast(pmod(xxhash64(vec_id, v, label), {shards}) as int)"))
    scores = near.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))  # at most ``positives_``
    asked = asking.join(scores, "anchor_id").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block, some, anchors_ in _by_length(left, right):
            for anchor, own, ps, v in zip(_ints(some, "anchor_id").tolist(), _ints(some, "label").tolist(), some.column("scores").to_pylist(), anchors_):
                bitmap = (block.labels != own) & (block.ids != anchor)
                windows = [(-(-low * p // 100), high * p // 100) for p in ps]
                for p, found in zip(ps, inside(block, v, bitmap, windows, negatives)):
                    out += [(anchor, p, i, _clip(score)) for i, score in found]
        return _table(out, ["anchor_id", "positive_score", "negative_id", "negative_score"])

    found = _dealt(dealt, asked, run, "anchor_id long, positive_score long, negative_id long, negative_score long", ["shard"], blocks)
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return near.join(ranked, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")
