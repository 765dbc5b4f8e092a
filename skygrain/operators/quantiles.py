"""Exact quantiles with linear interpolation, for groups of any size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain.operators.ordered import _PATH, _SIZE, _same, GROUP_LIMIT, cut_large_groups
from skygrain.session import durable, small_side


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Sequence[float],
    limit: int = GROUP_LIMIT,
    at_most: int | None = None,
) -> DataFrame:
    """One row per group with ``quantiles``: one double per entry of ``shares``.

    Groups up to ``limit`` rows use ``percentile``, which keeps all distinct values
    of a group in one task. A larger group is counted by value range first; the
    counts say which few ranges hold the wanted ranks, and only those are sorted.
    Infinities and NaN (beyond them) are counted apart, so ranks that fall on them need no rows, however many there are.
    Missing values are left out. ``at_most`` is a known bound of a group's rows.
    """
    keys, shares = list(keys), [float(s) for s in shares]
    every = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"))
    rows = every.filter(~F.isnan("_v") & (F.abs("_v") < float("inf")))
    slots = cut_large_groups(rows, keys, ["_v"], limit, at_most)
    # a group with few finite values has few distinct ones
    in_one_task = F.percentile("_v", F.array(*[F.lit(s) for s in shares])).alias("quantiles")
    if slots is None:
        return every.groupBy(*keys).agg(in_one_task)

    large = slots.table.select(*keys).distinct()
    small = (
        every.alias("l").join(small_side(large).alias("r"), _same(keys), "left_anti")
        .groupBy(*keys).agg(in_one_task))

    # in order: -Infinity, finite values, Infinity, NaN
    counted = every.groupBy(*keys).agg(
        F.count_if(F.col("_v") == float("-inf")).alias("_low_n"), F.count_if(F.col("_v") == float("inf")).alias("_high_n"),
        F.count(F.lit(1)).alias("_all"))
    sized = durable(
        slots.table.select(*keys, _SIZE).distinct().alias("l").join(counted.alias("r"), _same(keys))
        .select(*[F.col(f"l.{k}") for k in keys], F.col(f"l.{_SIZE}"), "r._low_n", "r._high_n", "r._all"), "sizes")
    # both ranks around every wanted share; those of finite values are looked up in the running counts
    at = F.col("_share") * (F.col("_all") - 1)
    ranks = (
        sized.withColumn("_share", F.explode(F.array(*[F.lit(s) for s in shares])))
        .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))))
        .select(*keys, (F.col("_rank") - F.col("_low_n")).alias("_rank"), _SIZE, "_low_n", "_high_n").distinct())
    special = (F.when(F.col("_rank") < 0, float("-inf")).when(F.col("_rank") < F.col(_SIZE), None)
               .when(F.col("_rank") < F.col(_SIZE) + F.col("_high_n"), float("inf")).otherwise(float("nan")))
    wanted = ranks.filter((F.col("_rank") >= 0) & (F.col("_rank") < F.col(_SIZE))).select(*keys, "_rank")
    beyond = ranks.filter((F.col("_rank") < 0) | (F.col("_rank") >= F.col(_SIZE))).select(*keys, "_rank", special.alias("_v"))
    held = durable(
        slots.table.alias("l").join(wanted.alias("r"), _same(keys))
        .filter((F.col("l._start") <= F.col("r._rank"))
                & (F.col("r._rank") < F.col("l._start") + F.col("l._rows")))
        .select(*[F.col(f"l.{k}") for k in keys], F.col(f"l.{_PATH}"), F.col("l._start"),
                F.col("l._low"), F.col("l._high"), F.col("r._rank")),
        "ranks")
    # a range of one repeated value needs no look at its rows; the outermost ranges also
    # hold all values beyond 1e300, which slots do not tell apart
    flat = (F.col("_low") == F.col("_high")) & (F.abs("_low") < 1e300)
    known = held.filter(flat).select(*keys, "_rank", F.col("_low").alias("_v"))
    open_slots = held.filter(~flat)
    inside = (
        slots.tag(rows).alias("l")
        .join(small_side(open_slots.select(*keys, _PATH, "_start").distinct()).alias("r"),
              _same(keys, _PATH))
        .select(*[F.col(f"l.{k}") for k in keys], F.col(f"l.{_PATH}"), F.col("l._v"), F.col("r._start")))
    by_value = Window.partitionBy(*keys, _PATH).orderBy("_v")
    numbered = inside.withColumn(
        "_rank", F.col("_start") + F.row_number().over(by_value) - 1)
    looked_up = (
        numbered.alias("l")
        .join(small_side(open_slots.select(*keys, "_rank")).alias("r"),
              _same(keys) & (F.col("l._rank") == F.col("r._rank")))
        .select(*[F.col(f"l.{k}") for k in keys], F.col("l._rank"), F.col("l._v")))
    found = known.unionByName(looked_up).unionByName(beyond)

    values = found.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))

    def interpolated(share: float):
        position = F.lit(share) * (F.col("r._all") - 1)
        low, high = F.floor(position), F.ceil(position)
        below, above = F.col("l._at")[low - F.col("r._low_n")], F.col("l._at")[high - F.col("r._low_n")]
        return F.when(low == high, below).otherwise(
            (high - position) * below + (position - low) * above)

    big = values.alias("l").join(sized.alias("r"), _same(keys)).select(
        *[F.col(f"l.{k}") for k in keys],
        F.array(*[interpolated(s) for s in shares]).alias("quantiles"))
    return small.unionByName(big)


# --- several columns at once ------------------------------------------------------

# Bits left out at each look at the values: sign, exponent and 8 bits first.
_SHIFTS = (44, 22, 0)
# Rows whose values are counted together before Spark adds up the counts.
_ROWS = 200_000


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles."""
    bits = (x + 0.0).view(np.int64)  # one zero only
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _prefix_counts(wide: DataFrame, columns: Sequence[str], shift: int, held: dict[int, np.ndarray] | None, before: int) -> DataFrame:
    """``_g, _c, _p, _n, _v``: values by the leading bits, of ``held`` ranges of the look before only; ``_v`` is the value if no bit is left out."""
    columns = list(columns)

    def count(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        group = rows.column("_g").to_numpy()
        for k, name in enumerate(columns):
            x = rows.column(name).to_numpy()  # a missing value is NaN
            take = ~np.isnan(x)
            bits = _ordered_bits(x)
            if held is not None:
                take &= np.isin(bits >> before, held.get(k, np.empty(0, np.int64)))
            if not take.any():
                continue
            found, first, place = np.unique(bits[take] >> shift, return_index=True, return_inverse=True)
            cells, n = np.unique(group[take].astype(np.int64) * len(found) + place, return_counts=True)
            at = cells % len(found)
            value = x[take][first][at] + 0.0
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells // len(found), pa.int32()), pa.array(np.full(len(n), k), pa.int32()), pa.array(found[at]), pa.array(n, pa.int64()),
                 pa.array(value, pa.float64(), mask=np.full(len(n), bool(shift)))], ["_g", "_c", "_p", "_n", "_v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= _ROWS:
                yield from count(pa.Table.from_batches(waiting))
                waiting, rows = [], 0
        if rows:
            yield from count(pa.Table.from_batches(waiting))

    counted = wide.mapInArrow(run, "_g int, _c int, _p long, _n long, _v double")
    return counted.groupBy("_g", "_c", "_p").agg(F.sum("_n").alias("_n"), F.max("_v").alias("_v"))


def column_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], keys: Sequence[str] = (), limit: int = GROUP_LIMIT, at_most: int | None = None,
) -> DataFrame:
    """``keys, column, quantiles`` of the values of each column that are neither missing nor NaN.

    Groups up to ``limit`` rows use ``percentile``. In larger ones, of which there are few, the values of all columns are
    counted by their leading bits in one scan; of the ranges that hold a wanted rank a further scan counts the values themselves
    (two, if a range has more than ``limit`` of them). Ranges are relative to the size of a value, so they suit any scale.
    """
    keys, columns, shares = list(keys), list(columns), [float(s) for s in shares]
    doubles = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])

    def in_one_task(rows: DataFrame) -> DataFrame:
        long = rows.unpivot(keys, columns, "column", "_v").filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        return long.groupBy(*keys, "column").agg(F.percentile("_v", F.array(*[F.lit(s) for s in shares])).alias("quantiles"))

    if (df.count() if at_most is None else at_most) <= limit:
        return in_one_task(doubles)
    small = None
    if keys:
        sizes = doubles.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        # at most one group for every ``limit`` rows
        large = sizes.filter(F.col("_rows") > limit).drop("_rows").collect()
        if not large:
            return in_one_task(doubles)
        groups = df.sparkSession.createDataFrame([(*row, g) for g, row in enumerate(large)], T.StructType([*[doubles.schema[k] for k in keys], T.StructField("_g", T.IntegerType())]))
        side = small_side(groups).alias("r")
        wide = doubles.alias("l").join(side, _same(keys)).select("r._g", *[F.col(f"l.`{c}`") for c in columns])
        small = in_one_task(doubles.alias("l").join(side, _same(keys), "left_anti"))
    else:
        wide = doubles.select(F.lit(0).alias("_g"), *[F.col(f"`{c}`") for c in columns])

    held, wanted, before, most, all_counts = None, None, 0, 0, None
    for shift in _SHIFTS:
        if held is not None and shift and most <= limit:
            continue
        counted = durable(_prefix_counts(wide, columns, shift, held, before), "prefixes")
        if wanted is None:
            upto = Window.partitionBy("_g", "_c").orderBy("_p")
            placed = counted.withColumn("_start", F.sum("_n").over(upto) - F.col("_n"))
            all_counts = counted.groupBy("_g", "_c").agg(F.sum("_n").alias("_all"))
            at = F.col("_share") * (F.col("_all") - 1)
            ranks = (all_counts.withColumn("_share", F.explode(F.array(*[F.lit(s) for s in shares])))
                     .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))))
                     .select("_g", "_c", "_rank").distinct())
            found = placed.join(ranks, ["_g", "_c"])
            all_counts = durable(all_counts, "sizes")
        else:
            outer = wanted.select("_g", "_c", F.col("_p").alias("_outer"), F.col("_start").alias("_from")).distinct()
            inside = counted.withColumn("_outer", F.shiftright("_p", before - shift)).join(small_side(outer), ["_g", "_c", "_outer"])
            upto = Window.partitionBy("_g", "_c", "_outer").orderBy("_p")
            placed = inside.withColumn("_start", F.col("_from") + F.sum("_n").over(upto) - F.col("_n"))
            found = placed.join(small_side(wanted.select("_g", "_c", F.col("_p").alias("_outer"), "_rank")), ["_g", "_c", "_outer"])
        inside = (F.col("_start") <= F.col("_rank")) & (F.col("_rank") < F.col("_start") + F.col("_n"))
        wanted = durable(found.filter(inside).select("_g", "_c", "_p", "_n", "_start", "_rank", "_v"), "ranks")
        if shift:
            # a few ranges for each large group and column
            here = wanted.select("_c", "_p", "_n").distinct().collect()
            most = max((r["_n"] for r in here), default=0)
            held = {k: np.unique([r["_p"] for r in here if r["_c"] == k]).astype(np.int64) for k in {r["_c"] for r in here}}
            before = shift

    values = wanted.groupBy("_g", "_c").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    sized = values.join(all_counts, ["_g", "_c"])

    def interpolated(share: float):
        position = F.lit(share) * (F.col("_all") - 1)
        low, high = F.floor(position), F.ceil(position)
        below, above = F.col("_at")[low], F.col("_at")[high]
        return F.when(below == above, below).otherwise((high - position) * below + (position - low) * above)

    names = F.array(*[F.lit(c) for c in columns])
    big = sized.select("_g", names[F.col("_c")].alias("column"), F.array(*[interpolated(s) for s in shares]).alias("quantiles"))
    if small is None:
        return big.drop("_g")
    return small.unionByName(big.join(F.broadcast(groups), "_g").select(*keys, "column", "quantiles"))
