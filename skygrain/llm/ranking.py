"""Ranked lexical search as dense matrix products of tiles.

Every document becomes its terms' 64-bit hashes and counts. Documents are dealt to tiles and items to blocks, both of a fixed
size, and every tile meets every block: the items are a stated query set. In a meeting the block's terms are
numbered anew, without gaps, and cut into column tiles. A column tile of item weights times a dense tile of document impacts
is one product of floats. All factors are whole, and a column tile is as wide as keeps every possible sum below 2^53, so
products are exact; they are added up as 64-bit integers. Each tile hands on its best documents, where ties go
to the smaller id as in the whole, so none of the final ones is lost.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygrain.llm.common import ragged, rows_for, slices
from skygrain.session import durable, small_side

TILE_DOCUMENTS, BLOCK_ITEMS, TILE_TERMS, SLAB = 2048, 256, 4096, 512
#: Fixed values of the ranking: scale of impacts, weight of a term's count, of the length norm, and its fixed and variable part.
SCALE, COUNT, NORM, WHOLE, VARIABLE = 1_000_000_000, 1000, 12, 100, 25
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_EXACT = 1 << 53
# No impact is greater, as lengths make a divisor larger.
_MOST = SCALE // COUNT


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and bytes beyond ASCII, A-Z in lower case."""
    return _TERM.findall(text.lower())


def analysed(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, n, terms, counts``: number of terms, and hash and count of each distinct one; a null text has none.

    Two terms are taken for one if their 64-bit hashes are equal: with a billion terms, one chance in 37 for any two of them,
    and far less that an item holds one.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [Counter(terms(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.total() for c in found], pa.int64()),
                 ragged([np.array([xxhash.xxh64_intdigest(t) for t in c], np.uint64).view(np.int64) for c in found], pa.int64()),
                 ragged([np.fromiter(c.values(), np.int64, len(c)) for c in found], pa.int64())], ["key", "n", "terms", "counts"])

    picked = rows.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return picked.mapInArrow(run, "key long, n long, terms array<long>, counts array<long>")


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the row of each."""
    values = [c.flatten().to_numpy() for c in lists.chunks]
    lengths = [c.value_lengths().to_numpy() for c in lists.chunks]
    if not values:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(values).astype(np.int64), np.repeat(np.arange(len(lists)), np.concatenate(lengths))


def _cuts(heaviest: np.ndarray, width: int = TILE_TERMS) -> list[int]:
    """Ends of column tiles: at most ``width`` columns, and no sum of weights times impacts of 2^53 or more but in a tile of one column."""
    cuts, total = [0], 0
    for i, weight in enumerate(heaviest.tolist()):
        if i > cuts[-1] and (i - cuts[-1] == width or (total + weight) * _MOST >= _EXACT):
            cuts.append(i)
            total = 0
        total += weight
    return [*cuts, len(heaviest)] if len(heaviest) else cuts


def scores(documents: tuple[np.ndarray, np.ndarray, np.ndarray], count: int, items: tuple[np.ndarray, np.ndarray, np.ndarray], asked: int) -> np.ndarray:
    """Exact scores, a row for each of ``count`` documents and a column for each of ``asked`` items.

    ``documents``: row, term and impact of each posting, by row; ``items``: row, term and weight.
    """
    row, term, impact = documents
    item, wanted, weight = items
    out = np.zeros((count, asked), np.int64)
    vocabulary, column = np.unique(wanted, return_inverse=True)
    if not len(vocabulary) or not count:
        return out
    at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
    known = vocabulary[at] == term
    row, at, impact = row[known], at[known], impact[known]
    heaviest = np.zeros(len(vocabulary), np.int64)
    np.maximum.at(heaviest, column, weight)
    cuts = _cuts(heaviest)
    for a, b in zip(cuts, cuts[1:]):
        exact = int(heaviest[a:b].sum()) * _MOST < _EXACT
        kind = float if exact else np.int64  # one column is too heavy for floats only if an item repeats a term 370,000 times
        mine = (column >= a) & (column < b)
        weights = np.zeros((b - a, asked), kind)
        weights[column[mine] - a, item[mine]] = weight[mine]
        here = np.flatnonzero((at >= a) & (at < b))
        slabs = np.searchsorted(row[here], np.arange(0, count + SLAB, SLAB))
        for k, (first, last) in enumerate(zip(slabs, slabs[1:])):
            if first == last:
                continue
            some, base = here[first:last], k * SLAB
            impacts = np.zeros((min(SLAB, count - base), b - a), kind)
            impacts[row[some] - base, at[some] - a] = impact[some]
            out[base:base + len(impacts)] += (impacts @ weights).astype(np.int64)
    return out


def best(found: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of each column its number and the rows of its ``k`` best scores above 0, equal ones by smaller id."""
    for item in range(found.shape[1]):
        column = found[:, item]
        rows = np.flatnonzero(column)
        if len(rows) > k:
            least = np.partition(column[rows], len(rows) - k)[len(rows) - k]
            rows = rows[column[rows] >= least]  # all that tie with the k-th
        if len(rows):
            yield item, rows[np.lexsort((ids[rows], -column[rows]))[:k]]


def search(documents: DataFrame, items: DataFrame, k: int, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0, equal scores by smaller id.

    Documents without a term (empty, null) are not counted and never found; those with a null id count in all
    statistics and are never found; rows that share an id are documents of their own. Items with a null id ask nothing; of items that share
    an id the one with the least text asks. An item whose terms occur nowhere has no rows. Empty tables give an empty
    result; other columns are not read.
    """
    docs = durable(analysed(documents, key, text).withColumn("row", F.monotonically_increasing_id()), "documents")
    asking = items.filter(F.col(item).isNotNull()).groupBy(F.col(item).cast("long").alias("item")).agg(F.min(text).alias("text"))
    asking = durable(analysed(asking, "item", "text").filter("n > 0"), "items")
    blocks = rows_for(asking.count(), BLOCK_ITEMS)
    total = docs.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    held, length = int(total.documents), max(1, int(total.terms or 0))

    wanted = durable(asking.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    frequencies = docs.select(F.explode("terms").alias("term")).join(small_side(wanted), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * held + 2.0)) / (F.coalesce("df", F.lit(0)) * 2.0 + 1.0))).cast("long")
    weights = durable(wanted.join(frequencies, "term", "left").select("term", weight.alias("weight")), "weights")
    parts = asking.select("key", F.explode(F.arrays_zip("terms", "counts")).alias("p")).select("key", F.col("p.terms").alias("term"), F.col("p.counts").alias("count"))
    # a list for each item, as long as its text
    queries = durable(parts.join(small_side(weights), "term").groupBy("key").agg(F.collect_list(F.struct("term", (F.col("count") * F.col("weight")).alias("weight"))).alias("v"))
                      .select("key", F.col("v.term").alias("terms"), F.col("v.weight").alias("weights")), "queries")

    tiles = rows_for(docs.count(), TILE_DOCUMENTS)
    norm = F.expr(f"{WHOLE - VARIABLE} + ({VARIABLE} * n * {held}L) div {length}L").alias("norm")
    dealt = docs.filter("n > 0 and key is not null").select(
        "key", "terms", "counts", norm, F.expr(f"cast(pmod(xxhash64(row), {tiles}) as int)").alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select("key", "terms", "weights", F.expr(f"cast(pmod(xxhash64(key), {blocks}) as int)").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("item_id", "doc_id", "score")})
        if not left.num_rows or not right.num_rows:
            return empty
        (term, row), (count, _) = _flat(left.column("terms")), _flat(left.column("counts"))
        impact = SCALE * count // (COUNT * count + NORM * left.column("norm").to_numpy()[row])
        (want, which), (heavy, _) = _flat(right.column("terms")), _flat(right.column("weights"))
        found = scores((row, term, impact), left.num_rows, (which, want, heavy), right.num_rows)
        ids, names = left.column("key").to_numpy(), right.column("key").to_numpy()
        rows = [(np.full(len(at), names[i]), ids[at], found[at, i]) for i, at in best(found, ids, k)]
        return pa.table({n: pa.array(np.concatenate([r[j] for r in rows])) for j, n in enumerate(("item_id", "doc_id", "score"))}) if rows else empty

    met = dealt.groupBy("tile", "block").cogroup(asked.groupBy("tile", "block")).applyInArrow(meet, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
