"""Model features: lags, rolling statistics, targets, and the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain import schema as S
from skygrain.functions.calendar import with_calendar
from skygrain.functions.index import with_aqi
from skygrain.functions.numbers import nan_to_null
from skygrain.functions.weather import derived_columns
from skygrain.operators.ordered import GROUP_LIMIT, Ordered, ordered
from skygrain.operators.rolling import spans


def lag_columns(columns: Sequence[str], window: WindowSpec, rows=S.LAG_HOURS) -> dict[str, Column]:
    return {S.lag_name(c, k): F.lag(c, k).over(window) for c in columns for k in rows}


def target_columns(window: WindowSpec, horizons=S.HORIZONS) -> dict[str, Column]:
    return {S.horizon_name(h): F.lead("aqi", h).over(window) for h in horizons}


def change_column(window: WindowSpec) -> dict[str, Column]:
    return {"aqi_change_1h": F.col("aqi") - F.lag("aqi", 1).over(window)}


def with_rolling(
    df: DataFrame,
    columns: Sequence[str],
    window: WindowSpec,
    sizes: Sequence[int] = S.ROLLING_WINDOWS,
    stats: Sequence[str] = ("mean", "std"),
) -> DataFrame:
    """Add rolling means and sample deviations over the last ``size`` rows.

    The current row counts, a shorter start is allowed, and missing values are
    skipped. Spark evaluates a sliding frame anew for every row, so a frame of 48
    costs 48 updates; here the sorted rows pass once (``rolling.spans``, with row numbers for the time). A constant
    window has deviation 0. Add other columns of ``window`` before: the result is no longer known to be sorted.
    """
    numbered = df.withColumn(_ROW, F.row_number().over(window).cast("long"))
    return _rolled(numbered, columns, _ROW, F.col(_ROW) == 1, sizes, stats, 1).drop(_ROW)


def _rolled(
    df: DataFrame, columns: Sequence[str], time: str, begins: Column, sizes: Sequence[int], stats: Sequence[str], unit: int,
) -> DataFrame:
    made = [(S.rolling_name(c, s, size), c, s, size * unit) for c in columns for size in sizes for s in stats]
    if not made:
        return df
    replaced = [name for name, *_ in made]
    marked = df.drop(*replaced).withColumn(_BEGINS, begins)
    out = T.StructType([*marked.drop(_BEGINS).schema.fields, *[T.StructField(name, T.DoubleType()) for name in replaced]])
    return marked.mapInArrow(lambda batches: spans(batches, time, _BEGINS, made), out)


HOUR = 3_600_000_000  # in the microseconds that aligned windows order by
MICROS = "_micros"
_BEGINS, _ROW = "_begins", "_row"


def aligned_order(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with the time as a number, and the order that begins with it: frames can then span time."""
    return df.withColumn(MICROS, F.unix_micros(F.col(order[0]).cast("timestamp"))), [MICROS, *order[1:]]


def by_time(o: Ordered) -> WindowSpec:
    """The window of ``o`` by its first order column alone, as frames over a range need it; rows are in that order already."""
    keys = [*o.keys] + (["_chunk"] if o.split else [])
    return Window.partitionBy(*keys).orderBy(o.order[0])


def _at(window: WindowSpec, hours: int) -> WindowSpec:
    """The rows of exactly that many hours later (earlier, if negative)."""
    return window.rangeBetween(hours * HOUR, hours * HOUR)


def _value_at(column: str, window: WindowSpec, hours: int, ties: Sequence[str]) -> Column:
    frame = _at(window, hours)
    return F.max_by(column, F.struct(*ties)).over(frame) if ties else F.max(column).over(frame)


def aligned_shifts(
    window: WindowSpec, ties: Sequence[str], columns: Sequence[str], hours: Sequence[int] = S.LAG_HOURS,
) -> dict[str, Column]:
    """The value of each column so many hours ago; NULL where no row has that very time.

    Of rows that share a time the one that is greatest by ``ties`` counts, also if its value is missing (without
    ``ties`` the greatest value).
    """
    return {S.lag_name(c, k): _value_at(c, window, -k, ties) for c in columns for k in hours}


def aligned_targets(window: WindowSpec, ties: Sequence[str], horizons: Sequence[int] = S.HORIZONS) -> dict[str, Column]:
    """The index so many hours ahead; NULL where no row has that very time."""
    return {S.horizon_name(h): _value_at("aqi", window, h, ties) for h in horizons}


def with_aligned_rolling(
    df: DataFrame, columns: Sequence[str], window: WindowSpec,
    sizes: Sequence[int] = S.ROLLING_WINDOWS, stats: Sequence[str] = ("mean", "std"),
) -> DataFrame:
    """Add rolling means and sample deviations over the last ``size`` hours, the current row's time included.

    A frame begins just after the time ``size`` hours ago, so hourly data without gaps give the same as frames of rows.
    Missing hours take no place: their values are neither filled in nor replaced by older ones. ``window`` is in the order of
    the time as a number (``aligned_order``). The sorted rows pass once, however many a frame holds.
    """
    return _rolled(df, columns, MICROS, F.row_number().over(window) == 1, sizes, stats, HOUR)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def engineer(
    observations: DataFrame,
    keys: Sequence[str] = S.KEYS,
    order: Sequence[str] = (S.TIME,),
    gap_policy: str = "cap",
    zone: str | None = None,
    target_hours: int = S.TARGET_HOURS,
    limit: int = GROUP_LIMIT,
    align: str = "rows",
    horizons: Sequence[int] = (),
) -> DataFrame:
    """All features of every observation, incomplete rows included.

    Columns missing from the input are skipped together with what derives from
    them. Every window has the same specification, so the plan has one exchange and
    one sort. ``order`` ends in a tie-break where times repeat within a key.

    ``align`` says what a lag, a rolling window or a target of k hours is: k rows ("rows", as if no hour were missing) or
    k hours by the clock ("time"). ``horizons`` adds the targets of the multi-horizon models in the same window.
    """
    if align not in ("rows", "time"):
        raise ValueError(f"unknown alignment {align!r}")
    observations = nan_to_null(observations)
    ahead = max(target_hours, *horizons) if horizons else target_hours
    if align == "time":
        df, by = aligned_order(observations, order)
        o = ordered(df, keys, by, limit=limit, back_range=float(max(*S.ROLLING_WINDOWS, *S.LAG_HOURS) * HOUR), ahead_range=float(ahead * HOUR))
        window, ties = by_time(o), list(order[1:])
        df = with_aqi(o.frame, gap_policy)
        shifted = {
            "aqi_change_1h": F.col("aqi") - _value_at("aqi", window, -1, ties),
            **aligned_shifts(window, ties, _present(df, S.LAG_COLUMNS)),
            S.TARGET: _value_at("aqi", window, target_hours, ties),
            **aligned_targets(window, ties, horizons),
        }
    else:
        reach_back = max(max(S.ROLLING_WINDOWS) - 1, max(S.LAG_HOURS))
        o = ordered(observations, keys, order, reach_back, ahead, limit)
        window, df = o.window, with_aqi(o.frame, gap_policy)
        shifted = {
            **change_column(o.window),
            **lag_columns(_present(df, S.LAG_COLUMNS), o.window),
            S.TARGET: F.lead("aqi", target_hours).over(o.window),
            **target_columns(o.window, horizons),
        }
    # the rolling columns come last, as they leave the window, and are then put before the others
    plain, rolling = df.columns, with_aligned_rolling if align == "time" else with_rolling
    df = rolling(df.select("*", *[e.alias(n) for n, e in shifted.items()]), _present(df, S.ROLLING_COLUMNS), window)
    rolled = [c for c in df.columns if c not in plain and c not in shifted]
    df = df.select(*plain, *rolled, *shifted)
    df = o.finish(df).drop(MICROS)
    return with_calendar(df.withColumns(derived_columns(df)), order[0], zone)


def complete_rows(df: DataFrame, except_for: Sequence[str] = ()) -> DataFrame:
    """Drop rows with any missing value, ignoring the columns ``except_for``."""
    return df.na.drop("any", subset=[c for c in df.columns if c not in except_for])


def with_targets(
    features: DataFrame,
    keys: Sequence[str] = S.KEYS,
    order: Sequence[str] = (S.TIME,),
    horizons: Sequence[int] = S.HORIZONS,
    limit: int = GROUP_LIMIT,
    align: str = "rows",
) -> DataFrame:
    """Add one target column per horizon and keep the rows that have all of them.

    The last ``max(horizons)`` rows of a key have no value that far ahead, so
    dropping missing targets drops them too. With ``align="time"`` a horizon is hours by the clock. Targets that
    ``engineer`` has added in its own window are taken as they are.
    """
    names = [S.horizon_name(h) for h in horizons]
    if not set(names) <= set(features.columns):
        if align == "time":
            df, by = aligned_order(features, order)
            o: Ordered = ordered(df, keys, by, limit=limit, ahead_range=float(max(horizons) * HOUR))
            targets = aligned_targets(by_time(o), list(order[1:]), horizons)
        else:
            o = ordered(features, keys, order, 0, max(horizons), limit)
            targets = target_columns(o.window, horizons)
        features = o.finish(o.frame.select("*", *[e.alias(n) for n, e in targets.items()])).drop(MICROS)
    return features.na.drop("any", subset=names)


def feature_columns(df: DataFrame, legacy: bool = False) -> list[str]:
    """Numeric columns a model may see.

    Left out are the target, the index itself and whatever derives from its current
    value; only its lags stay. The single-horizon model (``legacy``) drops only the
    target.
    """
    numeric = S.numeric_columns(df.schema)
    targets = {S.TARGET, *[S.horizon_name(h) for h in S.HORIZONS]}
    if legacy:
        return [c for c in numeric if c not in targets]
    return [c for c in numeric
            if c not in targets and c != "aqi"
            and (not c.startswith("aqi_") or c.startswith("aqi_lag_"))]


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the given columns to double, as a model input needs them."""
    wanted = {f.name for f in df.schema.fields
              if f.name in columns and not isinstance(f.dataType, T.DoubleType)}
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c in wanted})
