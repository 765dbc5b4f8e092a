"""Observation and feature tables: full build and incremental update."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators.features import engineer
from skygrain.operators.ordered import GROUP_LIMIT, ordered
from skygrain.operators.touched import POSITION, pieces, rows_of, touched_ranges
from skygrain.plans import state
from skygrain.plans.counts import Counts, written
from skygrain.plans.store import Store
from skygrain.session import durable, small_side
from skygrain.sources import versioned
from skygrain.sources.feature_table import INGESTED, PRIMARY_KEY, read_table, upsert
from skygrain.sources.versioned import MONTH

COMPLETE = state.COMPLETE
# a changed reading alters the target this many rows before it ...
TARGET_REACH = S.TARGET_HOURS
# ... and a feature depends on this many rows before it
FEATURE_REACH = max(max(S.ROLLING_WINDOWS) - 1, max(S.LAG_HOURS))
INDEX_KEY = (*S.KEYS, "month")


def _complete(df: DataFrame) -> Column:
    """All values present; only the target may still be unknown."""
    complete = F.lit(True)
    for c in df.columns:
        if c != S.TARGET:
            complete = complete & F.col(f"`{c}`").isNotNull()
    return complete


def feature_rows(
    observations: DataFrame, limit: int = GROUP_LIMIT, keys: Sequence[str] = S.KEYS, besides: Sequence[str] = (),
) -> DataFrame:
    """Features of all observations, marked complete or not; the columns ``besides`` are none.

    Incomplete rows are stored too: a reading that turns out missing then replaces
    the features it had.
    """
    features = engineer(observations, keys, limit=limit)
    return features.withColumn(COMPLETE, _complete(features.drop(*besides)))


def write_observations(spark: SparkSession, store: Store, batch: DataFrame, as_of: datetime, counts: Counts | None = None) -> None:
    """Upsert observations and count the rows of their cities' months anew."""
    batch = written(counts, batch, "observations")
    upsert(spark, store.observations, batch.withColumn(INGESTED, F.lit(as_of).cast("timestamp")))
    touched_months = durable(batch.select(*S.KEYS, _month(F.col(S.TIME)).alias(MONTH)).distinct(), "months")
    months = [r[0] for r in touched_months.select(MONTH).distinct().collect()]  # a calendar's worth
    rows = read_table(spark, store.observations, months).select(*S.KEYS, MONTH)
    sizes = rows.join(small_side(touched_months), [*S.KEYS, MONTH], "left_semi").groupBy(*S.KEYS, MONTH).agg(F.count(F.lit(1)).alias("rows"))
    versioned.append(spark, store.row_index, sizes.withColumnRenamed(MONTH, "month"), INDEX_KEY)


def _month(time: Column) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit(versioned.NO_MONTH))


def row_index(spark: SparkSession, store: Store) -> DataFrame:
    """``city, event_month, rows, start``: the rows of each city and month, and how many rows of the city lie before.

    Rows without a time are a month of their own, before all others.
    """
    counts = versioned.read(spark, store.row_index, INDEX_KEY).select(*S.KEYS, F.col("month").alias(MONTH), "rows")
    before = Window.partitionBy(*S.KEYS).orderBy(F.col(MONTH) != versioned.NO_MONTH, MONTH).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def read_observations(spark: SparkSession, store: Store) -> DataFrame:
    return read_table(spark, store.observations).drop(INGESTED, MONTH)


def read_features(spark: SparkSession, store: Store) -> DataFrame:
    """Complete feature rows; the target of the last rows is still NULL."""
    return read_table(spark, store.features).filter(F.col(COMPLETE)).drop(INGESTED, MONTH, COMPLETE)


def _store_features(spark: SparkSession, store: Store, rows: DataFrame, as_of: datetime, counts: Counts | None) -> None:
    stamped = written(counts, rows.withColumn(INGESTED, F.lit(as_of).cast("timestamp")), "features")
    upsert(spark, store.features, stamped, unique=True)
    state.merge(spark, store, stamped.drop(INGESTED))


def build_features(spark: SparkSession, store: Store, as_of: datetime, limit: int = GROUP_LIMIT, counts: Counts | None = None) -> None:
    """All features from all observations."""
    _store_features(spark, store, feature_rows(read_observations(spark, store), limit), as_of, counts)


@dataclass(frozen=True)
class Touched:
    """What an update computes again (``ranges``: city, low, high) and reads (``months``: city, month, start)."""

    ranges: DataFrame
    months: DataFrame


def _numbered(spark: SparkSession, store: Store, months: DataFrame, columns: Sequence[str] | None, limit: int) -> DataFrame:
    """Observations of some cities' months (``city, event_month, start``) with their row number within the city."""
    wanted = [r[0] for r in months.select(MONTH).distinct().collect()]  # a calendar's worth
    rows = read_table(spark, store.observations, wanted).drop(INGESTED)
    rows = (rows if columns is None else rows.select(*columns, MONTH)).join(small_side(months.select(*S.KEYS, MONTH, "start")), [*S.KEYS, MONTH])
    o = ordered(rows, [*S.KEYS, MONTH], [S.TIME], limit=limit)
    return o.finish(o.frame.withColumn(POSITION, F.col("start") + o.position)).drop("start", MONTH)


def touched(spark: SparkSession, store: Store, changed: DataFrame, limit: int = GROUP_LIMIT) -> Touched:
    """The rows whose features new or changed observations can alter, and the months to read for them.

    ``changed`` are rows already in the observation table. The counts per city and month give every month the number of its first
    row, so a row's number needs only its own month. A row alters the features up to ``FEATURE_REACH`` rows after it and
    the targets ``TARGET_REACH`` rows before it; whether it is new or corrected makes no difference.
    """
    keys = list(S.KEYS)
    moments = durable(changed.select(*keys, S.TIME).distinct(), "changed")
    index = durable(row_index(spark, store), "index")
    here = moments.select(*keys, _month(F.col(S.TIME)).alias(MONTH)).distinct()
    numbered = _numbered(spark, store, durable(index.join(here, [*keys, MONTH]), "months"), [*keys, S.TIME], limit)
    positions = numbered.join(small_side(moments), [*keys, S.TIME], "left_semi")
    ranges = durable(touched_ranges(positions, keys, TARGET_REACH, FEATURE_REACH), "ranges")
    wide = ranges.select(*keys, (F.col("low") - FEATURE_REACH).alias("first"), (F.col("high") + TARGET_REACH).alias("last"))
    reach = index.join(wide, keys).filter("start <= last and start + rows > first").select(*keys, MONTH, "start").distinct()
    return Touched(ranges, durable(reach, "read"))


def update_features(
    spark: SparkSession, store: Store, changed: DataFrame, as_of: datetime, limit: int = GROUP_LIMIT, counts: Counts | None = None
) -> None:
    """Recompute the features that new or changed observations can alter; the result equals a full build.

    Work and reading follow the number of changes: see ``touched``.
    """
    if not versioned.exists(spark, store.features):
        build_features(spark, store, as_of, limit, counts)
        return
    if changed.isEmpty():
        return
    t = touched(spark, store, changed, limit)
    cut = pieces(t.ranges, S.KEYS, FEATURE_REACH, TARGET_REACH)
    rows = durable(rows_of(_numbered(spark, store, t.months, None, limit), cut, S.KEYS), "rows")
    helpers = ["_piece", "_emit"]
    found = feature_rows(rows, limit, [*S.KEYS, "_piece"], helpers)
    _store_features(spark, store, found.filter("_emit").drop(*helpers), as_of, counts)
