"""Threshold alerts: candidates, wording, deduplication, history and summary.

Nothing here reads a clock: the moment of a check is the argument ``as_of``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions import alert_text as A
from skygrain.functions.numbers import one_decimal
from skygrain.operators.series import newest
from skygrain.session import small_side

# Fixed value: alerts a trimmed history keeps.
RETAINED = 1000


def each_model(models: Sequence[tuple[int, str]]) -> Column:
    """A row for every (horizon, model)."""
    return F.explode(F.array(*[F.struct(F.lit(h).cast("int").alias("horizon"), F.lit(m).alias("model")) for h, m in models]))


def candidates(
    current: DataFrame, predictions: DataFrame | None = None, keys: Sequence[str] = S.KEYS,
    models: Sequence[tuple[int, str]] | None = None,
) -> DataFrame:
    """Values to check: the current one of each key and all its predictions.

    ``current`` has keys, ``as_of`` and ``current``; ``predictions`` is long, with
    ``horizon``, ``model`` and ``prediction``. A missing prediction counts as the
    current value; with ``models``, a list of (horizon, model), one without a row is missing too.
    """
    now = current.select(
        *keys, F.col("as_of").alias("timestamp"), F.lit("current").alias("source"),
        F.col("current").cast("double").alias("aqi"))
    if predictions is None and not models:
        return now
    known = current.select(*keys, "as_of", F.col("current").cast("double").alias("_current"))
    if models is None:
        joined = predictions.join(known, [*keys, "as_of"])
    else:
        wanted = known.withColumn("_m", each_model(models)).select(*known.columns, "_m.*")
        joined = (wanted.withColumn("prediction", F.lit(None).cast("double")) if predictions is None
                  else wanted.join(predictions, [*keys, "as_of", "horizon", "model"], "left"))
    ahead = joined.select(
        *keys, F.col("as_of").alias("timestamp"),
        F.concat(F.col("horizon").cast("string"), F.lit("h_"), F.col("model")).alias("source"),
        F.coalesce(F.col("prediction"), F.col("_current")).alias("aqi"))
    return now.unionByName(ahead)


def build_alerts(checked: DataFrame, value: str = "aqi") -> DataFrame:
    """One alert per value above the lowest threshold, replacing ``value``."""
    aqi = F.col(value).cast("double")
    others = [c for c in checked.columns if c not in (value, "source")]
    return checked.filter(aqi > A.ALERT_ABOVE).select(
        *others,
        one_decimal(aqi).alias("aqi_value"),
        A.severity(aqi).alias("severity"),
        "source",
        A.message(aqi, F.col("source")).alias("message"),
        A.threshold_text(aqi).alias("threshold_exceeded"),
        A.recommendations(aqi).alias("recommendations"),
    )


def _moment(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def new_alerts(
    alerts: DataFrame,
    history: DataFrame,
    as_of: datetime | Column,
    keys: Sequence[str] = S.KEYS,
    hours: int = 1,
    near: float = 5.0,
) -> DataFrame:
    """Alerts without a similar one in the history.

    Similar: same keys, source and severity, later than ``hours`` before ``as_of``,
    and less than ``near`` apart. Alerts of the same check are not compared.

    Of the history only distinct values matter, and values have one decimal: at
    most ``10 * near`` of them share a cell of width ``near``. An alert meets its own
    and the two neighbouring cells, never a whole source.
    """
    same = [*keys, "source", "severity"]

    def cell(v: str) -> Column:
        return F.floor(F.col(v) / F.lit(near)).cast("long")

    recent = (
        history.filter(F.col("timestamp") > _moment(as_of) - F.make_dt_interval(hours=F.lit(hours)))
        .select(*same, F.col("aqi_value").alias("_seen")).distinct()
        .withColumn("_cell", F.explode(F.array(
            cell("_seen") - 1, cell("_seen"), cell("_seen") + 1))))
    left, right = alerts.withColumn("_cell", cell("aqi_value")).alias("l"), small_side(recent).alias("r")
    match = F.col("l._cell") == F.col("r._cell")
    for c in same:
        match = match & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    match = match & (F.abs(F.col("r._seen") - F.col("l.aqi_value")) < near)
    return left.join(right, match, "left_anti").drop("_cell")


def recent_alerts(
    history: DataFrame, as_of: datetime | Column, hours: int = 24, n: int | None = None,
    order: Sequence[str] = ("timestamp", "source"),
) -> DataFrame:
    """Alerts of the last ``hours`` hours, newest first, optionally the first ``n``."""
    recent = history.filter(
        F.col("timestamp") > _moment(as_of) - F.make_dt_interval(hours=F.lit(hours)))
    return recent.orderBy(*[F.desc(c) for c in order]) if n is None else newest(recent, n, (), order)


def critical_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("severity") == "critical")


def retained(
    history: DataFrame, n: int = RETAINED, keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp", "source"),
) -> DataFrame:
    """The last ``n`` alerts, overall or per key."""
    return newest(history, n, keys, order)


def alert_summary(
    history: DataFrame,
    as_of: datetime | Column,
    hours: int = 24,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp", "source"),
) -> DataFrame:
    """Number of alerts, number per severity, the latest and the highest one.

    Of equally high alerts the latest counts. Without alerts there is one row with
    zero counts (no row per key, if keys are given).
    """
    recent = history.filter(
        F.col("timestamp") > _moment(as_of) - F.make_dt_interval(hours=F.lit(hours)))
    alert = F.struct("timestamp", "aqi_value", "severity", "source", "message")
    position = F.struct(*order)
    counts = [F.coalesce(F.sum((F.col("severity") == s[0]).cast("long")), F.lit(0)).alias(f"{s[0]}_count")
              for s in A.SEVERITIES]
    return recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_alerts"), *counts,
        F.max_by(alert, position).alias("latest_alert"),
        F.max_by(alert, F.struct("aqi_value", *order)).alias("highest_aqi"))
