"""Which rows an update has to compute again: changed positions as disjoint ranges of row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POSITION = "_pos"
# Positions whose changes one task joins first, and the rows of a piece that is computed together.
BLOCK, PIECE, CELL = 4096, 250_000, 64


def _joined(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranges that overlap or touch, as one; ``by`` is the window's group."""
    order = Window.partitionBy(*by).orderBy("low")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(before.isNull() | (F.col("low") > before + 1), 1).otherwise(0)
    run = ranges.withColumn("_first", first).withColumn("_run", F.sum("_first").over(order))
    return run.groupBy(*by, "_run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_run")


def touched_ranges(positions: DataFrame, keys: Sequence[str], before: int, after: int) -> DataFrame:
    """``keys, low, high``: all rows from ``before`` rows before to ``after`` rows after a changed position, disjoint.

    ``positions`` has the keys and ``_pos`` (from 0), in any order, repeats allowed. Positions are joined in blocks first, so a
    key with very many changes is spread over tasks; only the ranges of the blocks meet per key. ``high``
    may lie beyond the last row.
    """
    spans = positions.select(*keys, F.floor(F.col(POSITION) / BLOCK).alias("_block"), F.greatest(F.lit(0), F.col(POSITION) - before).cast("long").alias("low"),
                             (F.col(POSITION) + after).cast("long").alias("high")).distinct()
    return _joined(_joined(spans, [*keys, "_block"]).drop("_block"), keys)


def pieces(ranges: DataFrame, keys: Sequence[str], back: int, ahead: int) -> DataFrame:
    """Ranges cut into pieces of bounded size, with the rows each needs around it: ``low, high`` and ``first, last``."""
    start = F.explode(F.sequence("low", "high", F.lit(PIECE).cast("long")))
    cut = ranges.select(*keys, "high", start.alias("low")).withColumn("high", F.least("high", F.col("low") + (PIECE - 1)))
    return cut.withColumns({"first": F.greatest(F.lit(0), F.col("low") - back), "last": F.col("high") + ahead})


def rows_of(numbered: DataFrame, cut: DataFrame, keys: Sequence[str], piece: str = "_piece", emit: str = "_emit") -> DataFrame:
    """Every row once for each piece that needs it, and whether it is the piece's own.

    ``numbered`` has ``_pos``. Rows and pieces meet by cell of ``CELL`` row numbers, an equality.
    """
    cells = F.explode(F.sequence(F.floor(F.col("first") / CELL), F.floor(F.col("last") / CELL)))
    wanted = cut.select(*keys, "low", "high", "first", "last", cells.alias("_cell")).alias("r")
    rows = numbered.withColumn("_cell", F.floor(F.col(POSITION) / CELL)).alias("l")
    match = F.col("l._cell") == F.col("r._cell")
    for k in keys:
        match = match & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    at = F.col(f"l.{POSITION}")
    return rows.join(wanted, match).filter((at >= F.col("r.first")) & (at <= F.col("r.last"))).select(
        *[F.col(f"l.`{c}`") for c in numbered.columns if c != POSITION], F.col("r.low").alias(piece),
        ((at >= F.col("r.low")) & (at <= F.col("r.high"))).alias(emit))
