"""Ordered work per group when one group may hold a large share of all rows.

``Window.partitionBy("city")`` puts a whole city in one task. That is right while
every city is small and hopeless when one holds a third of the table. This module
counts first. If no group exceeds ``limit`` rows, callers get the plain window.
Otherwise the large groups alone are cut into runs of neighbouring rows:

1. A large group's order range is cut into equal-width *slots* and the rows per
   slot are counted. Slots that are still too full are cut again, by the next order
   column once the first no longer tells rows apart. Only counts are kept, so each
   pass is one column-pruned scan with partial aggregation.
2. The running total of slot counts gives every slot its exact first row number.
3. Slots are gathered into *chunks*, and each chunk also receives the slots that
   hold the ``back`` rows before and the ``ahead`` rows after it. Frames that reach
   no further give the same value in a chunk as in the whole group.

Row numbers stay exact because a slot knows how many rows precede it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain.session import durable, small_side

# Rows one task may sort. About 100 double columns per row make this some 400 MB.
GROUP_LIMIT = 500_000
# Slots of a limit, and chunks: a chunk gets whole slots from both sides, so these are small beside it, and
# tasks that get several chunks are the more even the smaller those are.
SLOTS, CHUNKS = 64, 4
# Limits that all large groups together are cut into, about: a small limit says which groups are cut, but slots and chunks
# grow with the table, up to those of ``GROUP_LIMIT``, so that the slots of any table can be broadcast.
LIMITS = 1024
# Chunks of a task from which on they even out by themselves.
SHARED = 8

_PATH, _CHUNK, _OWN, _FIRST, _SIZE = "_path", "_chunk", "_own", "_first", "_size"
# Two values closer than this are not told apart by a slot.
_TINY = 1e-290


def _as_number(df: DataFrame, name: str) -> Column:
    """A double that never decreases along the order of ``name``."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        column = column.cast("timestamp")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.NumericType):
        return F.greatest(F.lit(-1e300), F.least(F.lit(1e300), column.cast("double")))
    raise TypeError(f"cannot cut groups by {name}: {kind.simpleString()}")


def _same(keys: Sequence[str], path: str | None = None):
    """Null-safe join condition of aliases ``l`` and ``r``."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    if path:
        condition = condition & (F.col(f"l.{path}") == F.col(f"r.{path}"))
    return condition


def _cell(numbers: list[str], level: str) -> Column:
    """The slot of a row within its level; a missing order value comes first."""
    value = F.coalesce(*[
        F.when(F.col(f"{level}._dim") == i, F.col(name)) for i, name in enumerate(numbers)])
    raw = F.floor((value - F.col(f"{level}._low")) / F.col(f"{level}._width"))
    return F.coalesce(
        F.greatest(F.lit(0), F.least(raw, F.col(f"{level}._cells") - 1)), F.lit(0)).cast("int")


@dataclass(frozen=True)
class Slots:
    """Slots of the groups above the limit: ``levels`` cut, ``table`` is the result.

    ``table`` has the keys, the slot path, its first row number, its row count, the
    group's row count and the slot's range of the first order column. ``rows`` is the
    number of all rows in it and ``limit`` the number a slot does not exceed if it can
    be cut.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    levels: tuple[DataFrame, ...]
    table: DataFrame
    limit: int
    rows: int

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the slot path to every row; NULL in groups below the limit."""
        numbers = [f"_o{i}" for i in range(len(self.order))]
        plain = [F.col(f"l.`{c}`") for c in df.columns]
        carried = [F.col(f"l.{n}") for n in numbers]
        out = df.withColumns({n: _as_number(df, c) for n, c in zip(numbers, self.order)})
        for depth, level in enumerate(self.levels):
            if depth == 0:
                joined = out.alias("l").join(
                    small_side(level).alias("r"), _same(self.keys), "left")
                path = F.when(F.col("r._cells").isNotNull(), F.array(_cell(numbers, "r")))
            else:
                joined = out.alias("l").join(
                    small_side(level).alias("r"), _same(self.keys, _PATH), "left")
                path = F.when(
                    F.col("r._cells").isNotNull(),
                    F.concat(F.col(f"l.{_PATH}"), F.array(_cell(numbers, "r"))),
                ).otherwise(F.col(f"l.{_PATH}"))
            out = joined.select(*plain, *carried, path.alias(_PATH))
        return out.drop(*numbers)


def cut_large_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int = GROUP_LIMIT,
    at_most: int | None = None,
) -> Slots | None:
    """Slots for the groups of more than ``limit`` rows, or None if there are none.

    ``at_most`` is a known bound of a group's rows. Without it the table is counted,
    for stored Parquet from its footers; groups are counted only if it is larger.
    Groups of more than ``limit`` rows are cut; where there are very many rows for so
    small a limit, slots hold more (``LIMITS``).
    """
    keys, order = tuple(keys), tuple(order)
    if (df.count() if at_most is None else at_most) <= limit:
        return None
    numbers = [f"_o{i}" for i in range(len(order))]
    narrow = df.select(*keys, *[_as_number(df, c).alias(n) for n, c in zip(numbers, order)])
    measures = [F.count(F.lit(1)).alias("_n")]
    measures += [F.min(n).alias(f"_min{i}") for i, n in enumerate(numbers)]
    measures += [F.max(n).alias(f"_max{i}") for i, n in enumerate(numbers)]
    # the first order column that still tells the rows of a slot apart
    splits = [F.coalesce(F.col(f"_max{i}") - F.col(f"_min{i}") > _TINY, F.lit(False))
              for i in range(len(order))]
    dim = F.coalesce(*[F.when(s, F.lit(i)) for i, s in enumerate(splits)])

    def level_of(counted: DataFrame) -> DataFrame:
        low = F.coalesce(*[F.when(F.col("_dim") == i, F.col(f"_min{i}")) for i in range(len(order))])
        high = F.coalesce(*[F.when(F.col("_dim") == i, F.col(f"_max{i}")) for i in range(len(order))])
        cells = F.greatest(F.lit(2), F.ceil(F.col("_n") / F.lit(slot_rows)).cast("int"))
        return (counted.withColumn("_dim", dim)
                .select(*keys, _PATH, "_dim", low.alias("_low"),
                        ((high - low) / cells).alias("_width"), cells.alias("_cells")))

    top = F.array().cast("array<int>")
    sizes = narrow.groupBy(*keys).agg(*measures).filter(F.col("_n") > limit)
    full = durable(sizes.withColumn(_PATH, top), "sizes")
    total = full.agg(F.sum("_n")).first()[0]
    if total is None:
        return None
    limit = max(limit, min(GROUP_LIMIT, total // LIMITS))
    slot_rows = max(1, limit // SLOTS)
    splittable = F.coalesce(dim, F.lit(-1)) >= 0

    levels: list[DataFrame] = []
    done = [full.filter(~splittable)]
    pending = full.filter(splittable)
    rows = narrow.withColumn(_PATH, top)
    while not pending.isEmpty():
        level = level_of(pending)
        levels.append(level)
        rows = (rows.alias("l")
                .join(small_side(level).alias("r"), _same(keys, _PATH))
                .select(*[F.col(f"l.{k}") for k in keys], *[F.col(f"l.{n}") for n in numbers],
                        F.concat(F.col(f"l.{_PATH}"), F.array(_cell(numbers, "r"))).alias(_PATH)))
        counted = durable(rows.groupBy(*keys, _PATH).agg(*measures), "slots")
        again = (F.col("_n") > limit) & splittable
        done.append(counted.filter(~again))
        pending = counted.filter(again)

    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.unionByName(more)
    by_path = Window.partitionBy(*keys).orderBy(_PATH)
    table = leaves.select(
        *keys, _PATH, F.col("_n").alias("_rows"),
        (F.sum("_n").over(by_path.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias(_SIZE),
        F.col("_min0").alias("_low"), F.col("_max0").alias("_high"))
    return Slots(keys, order, tuple(levels), durable(table, "table"), limit, total)


@dataclass(frozen=True)
class Ordered:
    """A frame ready for row-positional windows.

    Build columns on ``frame`` over ``window`` and pass the result to ``finish``. The
    frame is already shuffled and sorted for the window: row expressions that are
    added to it are neither shuffled nor sorted along.
    """

    frame: DataFrame
    window: WindowSpec
    position: Column
    size: Column
    split: bool
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def finish(self, df: DataFrame) -> DataFrame:
        if not self.split:
            return df
        return df.filter(F.col(_OWN)).drop(_CHUNK, _OWN, _FIRST, _SIZE)


def _reach(
    chunks: DataFrame, table: DataFrame, keys: Sequence[str], back: float | None, ahead: float | None,
) -> DataFrame:
    """``chunks`` with rows that cover the given range of order values around each.

    Slots and wanted bounds are sorted together. Every slot that ends below a lower bound is left out, and with it
    all slots before it: the greatest last row of those is where the chunk begins. The upper end mirrors this.
    """
    last = F.col("_start") + F.col("_rows")

    def bound(slot_value: str, slot_row: Column, wanted: Column, below: bool) -> DataFrame:
        # slots come after bounds of the same value: they hold rows that lie exactly on the bound, so they are not left out
        slots = table.filter(F.col(slot_value).isNotNull()).select(
            *keys, F.lit(None).cast("long").alias(_CHUNK), F.col(slot_value).alias("_v"), F.lit(1).alias("_t"), slot_row.cast("long").alias("_r"))
        points = chunks.select(*keys, F.col(_CHUNK).cast("long").alias(_CHUNK), wanted.alias("_v"), F.lit(0).alias("_t"), F.lit(None).cast("long").alias("_r"))
        w = Window.partitionBy(*keys).orderBy(F.col("_v") if below else -F.col("_v"), "_t").rowsBetween(Window.unboundedPreceding, 0)
        found = (F.max("_r") if below else F.min("_r")).over(w)
        return slots.union(points).withColumn("_r", found).filter(F.col(_CHUNK).isNotNull()).select(*keys, _CHUNK, "_r")

    out = chunks
    sides = [("_high", last, "_low", back, True, "_low_row")] if back is not None else []
    sides += [("_low", F.col("_start"), "_high", ahead, False, "_high_row")] if ahead is not None else []
    for slot_value, row, own, reach, below, name in sides:
        found = bound(slot_value, row, F.col(own) - F.lit(reach) if below else F.col(own) + F.lit(reach), below)
        # without a slot beyond the bound the chunk reaches the end of its group; rows without a value reach nobody
        edge = F.coalesce("r._r", F.lit(0 if below else 1 << 62))
        edge = F.when(F.col(f"l.{own}").isNull(), F.col(f"l.{name}")).otherwise((F.least if below else F.greatest)(f"l.{name}", edge))
        out = out.alias("l").join(found.alias("r"), _same([*keys, _CHUNK])).select(
            *[F.col(f"l.`{c}`") for c in out.columns if c != name], edge.alias(name))
    size = table.groupBy(*keys).agg(F.max(last).alias("_end"))
    return out.alias("l").join(size.alias("r"), _same(keys)).select(
        *[F.col(f"l.`{c}`") for c in out.columns if c != "_high_row"], F.least("l._high_row", "r._end").alias("_high_row"))


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    back: int = 0,
    ahead: int = 0,
    limit: int = GROUP_LIMIT,
    back_range: float | None = None,
    ahead_range: float | None = None,
) -> Ordered:
    """Prepare windows that reach ``back`` rows before and ``ahead`` rows after a row.

    ``back_range`` and ``ahead_range`` say how far frames reach in values of the first order column, a number:
    each chunk then also gets all rows that are no further away, however many or few there are.
    ``position`` (from 0) and ``size`` are those of the whole group in either form.
    """
    slots = cut_large_groups(df, keys, order, limit)
    if slots is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)
        return Ordered(
            placed, window, F.row_number().over(window) - 1,
            F.count(F.lit(1)).over(Window.partitionBy(*keys)), False, tuple(keys), tuple(order))

    first, last = F.col("_start"), F.col("_start") + F.col("_rows")

    def chunked(target: int) -> tuple[DataFrame, DataFrame]:
        table = slots.table.filter(F.col("_rows") > 0).withColumn(_CHUNK, F.floor(F.col("_start") / target))
        chunks = table.groupBy(*keys, _CHUNK).agg(
            (F.min(first) - back).alias("_low_row"), (F.max(last) + ahead).alias("_high_row"), F.sum("_rows").alias("_rows"),
            F.min("_low").alias("_low"), F.max("_high").alias("_high"))
        if back_range is not None or ahead_range is not None:
            chunks = _reach(chunks, table, keys, back_range, ahead_range)
        return table, chunks

    target = max(slots.limit // CHUNKS, 1)
    table, chunks = chunked(target)
    if back_range is not None or ahead_range is not None:
        # a chunk has at least as many rows as its frames reach beyond it: rows are sent a few times, however dense they are
        beyond = chunks.agg(F.max(F.col("_high_row") - F.greatest("_low_row", F.lit(0)) - F.col("_rows"))).first()[0]
        if beyond is not None and beyond > target:
            target = int(beyond)
            table, chunks = chunked(target)

    def cells(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / target), F.floor(high / target)))

    # interval overlap as an equality join on cells of ``target`` row numbers
    per_slot = table.withColumn("_cell", cells(first, last - 1)).alias("l")
    per_chunk = chunks.withColumn(
        "_cell", cells(F.greatest("_low_row", F.lit(0)), F.col("_high_row") - 1)).alias("r")
    sent = (
        per_slot.join(per_chunk, _same(slots.keys) & (F.col("l._cell") == F.col("r._cell")))
        .filter((F.col("l._start") < F.col("r._high_row"))
                & (F.col("l._start") + F.col("l._rows") > F.col("r._low_row")))
        .select(*[F.col(f"l.{k}") for k in slots.keys], F.col(f"l.{_PATH}"),
                F.col("l._start"), F.col(f"l.{_SIZE}"), F.col(f"r.{_CHUNK}"),
                (F.col(f"l.{_CHUNK}") == F.col(f"r.{_CHUNK}")).alias(_OWN))
        .distinct()
    )
    start_of_chunk = F.min("_start").over(Window.partitionBy(*slots.keys, _CHUNK))
    routes = durable(
        sent.withColumn(_FIRST, start_of_chunk)
        .groupBy(*slots.keys, _PATH)
        .agg(F.collect_list(F.struct(_CHUNK, _OWN, _FIRST, _SIZE)).alias("_to")),
        "routes")
    tagged = slots.tag(df)
    routed = (
        tagged.alias("l")
        .join(small_side(routes).alias("r"), _same(slots.keys, _PATH), "left")
        .select(*[F.col(f"l.`{c}`") for c in df.columns], F.explode_outer("r._to").alias("_t"))
        .select(*[F.col(f"`{c}`") for c in df.columns],
                F.coalesce(f"_t.{_CHUNK}", F.lit(0)).alias(_CHUNK),
                F.coalesce(f"_t.{_OWN}", F.lit(True)).alias(_OWN),
                F.coalesce(f"_t.{_FIRST}", F.lit(0)).alias(_FIRST),
                F.col(f"_t.{_SIZE}").alias(_SIZE))
    )
    # as many tasks as chunks, so that a task with several does not keep all others waiting; where chunks are many and
    # small, as many as chunks of ``GROUP_LIMIT`` would be
    partitions, tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-slots.rows // target)
    if tasks > SHARED * partitions:
        tasks = min(tasks, -(-slots.rows // (GROUP_LIMIT // CHUNKS)))
    tasks = max(partitions, tasks)
    routed = routed.repartition(tasks, *keys, _CHUNK).sortWithinPartitions(*keys, _CHUNK, *order)
    window = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    whole = F.count(F.lit(1)).over(Window.partitionBy(*keys, _CHUNK))
    return Ordered(
        routed, window, F.col(_FIRST) + F.row_number().over(window) - 1,
        F.coalesce(F.col(_SIZE), whole), True, tuple(keys), tuple(order))
