"""Exact-size selections and global row numbers without a sort of the whole table in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain.session import durable, small_side

# Hex digits by which a pass refines its slots, and rows of the last slot that are put in order.
DIGITS, LAST = 3, 100_000
POSITION = "position"


def key_hash(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """MD5 of the key as text: an order that depends on nothing but the key and the seed.

    Times count as microseconds, a missing value as an empty text.
    """
    def text(name: str) -> Column:
        kind, column = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        return F.coalesce(column.cast("string"), F.lit(""))

    return F.md5(F.concat_ws("|", *[text(k) for k in keys], F.lit(str(seed))).cast("binary"))


def hash_cut(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> str | None:
    """The hash of the ``n``-th row by ``key_hash``; NULL if ``n`` is 0 or beyond the table.

    Rows are counted by the first digits of their hash; the slot that holds the wanted rank is counted again by
    the next ones, until it is small enough to be put in order. Every pass reads the keys once and hands
    on at most 16^3 counts a task.
    """
    rows = df.select(key_hash(df, keys, seed).alias("_h"))
    prefix, rank = "", n
    if n < 1:
        return None
    while True:
        depth = len(prefix) + DIGITS
        slots = sorted((r.p, r.n) for r in rows.filter(F.col("_h").startswith(prefix)).groupBy(F.substring("_h", 1, depth).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        for slot, count in slots:
            if rank <= count:
                break
            rank -= count
        else:
            return None
        prefix = slot
        if depth >= 30:
            return prefix + "g"  # all that is left are copies of one key: they stay together
        if count <= LAST:
            return rows.filter(F.col("_h").startswith(prefix)).orderBy("_h").limit(rank).agg(F.max("_h")).first()[0]


def random_split(df: DataFrame, keys: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Add ``split``: "train" for exactly ``floor(n * share)`` rows, "test" for the others.

    Which ones depends on the key and the seed alone, not on the layout. Rows that share a key are on one side, so with repeated keys
    the size is exact but for the copies of the key at the cut.
    """
    cut = hash_cut(df, keys, int(df.count() * share), seed)
    if cut is None:
        return df.withColumn("split", F.lit("test"))  # too few rows for one in training
    return df.withColumn("split", F.when(key_hash(df, keys, seed) <= cut, "train").otherwise("test"))


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows picked by the hash of their key, the same on every run; all rows if there are fewer.

    A filter: the rows are neither sorted nor moved. Copies of the key at the cut come along.
    """
    if n < 1:
        return df.limit(0)
    cut = hash_cut(df, keys, n, seed)
    return df if cut is None else df.filter(key_hash(df, keys, seed) <= cut)


def sorted_table(df: DataFrame, order: Sequence[str | Column], name: str = POSITION) -> DataFrame:
    """``df`` written in order, with the number of each row (from 0) in the whole table.

    Rows are dealt to tasks by range and sorted there; a row's number is its place in its task plus the rows of all tasks before,
    of which one count each is kept. No task sees more than its range. Rows that tie in ``order`` are dealt
    to several tasks if there are many, and numbered in any order.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    ties = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = ties.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, F.col("_tie")).drop("_tie")
    # the lower bits of this id number the rows of a task in the order in which they come
    numbered = dealt.withColumns({"_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    written = durable(numbered, "sorted")
    sizes = sorted((r["_task"], r.n) for r in written.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect())  # a row a task
    starts, total = [], 0
    for task, n in sizes:
        starts.append((task, total))
        total += n
    before = df.sparkSession.createDataFrame(starts, "_task int, _start long")
    return written.join(small_side(before), "_task").withColumn(name, F.col("_start") + F.col("_place")).drop("_task", "_place", "_start")
