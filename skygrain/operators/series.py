"""Time-series operators: splits, latest values, resampling, seasonality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions.numbers import pearson
from skygrain.operators.ordered import GROUP_LIMIT, ordered
from skygrain.session import durable, small_side


def chronological_split(
    df: DataFrame,
    keys: Sequence[str] = S.KEYS,
    order: Sequence[str] = (S.TIME,),
    share: float = S.TRAIN_SHARE,
    embargo: int = 0,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Add ``split``: "train" for the first ``int(n * share)`` rows of a key, then "test".

    ``embargo`` takes the last rows before the cut out of training.
    """
    o = ordered(df, keys, order, limit=limit)
    cut = F.floor(o.size.cast("double") * F.lit(float(share)))
    placed = o.frame.select("*", o.position.alias("_pos"), cut.alias("_cut"))
    label = F.when(F.col("_pos") < F.col("_cut") - embargo, "train").when(
        F.col("_pos") >= F.col("_cut"), "test")
    out = o.finish(placed.withColumn("split", label).drop("_pos", "_cut"))
    return out.filter(F.col("split").isNotNull()) if embargo else out


def split_boundaries(
    df: DataFrame,
    keys: Sequence[str] = S.KEYS,
    order: Sequence[str] = (S.TIME,),
    share: float = S.TRAIN_SHARE,
    embargo: int = 0,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Per key where testing begins and where training ends, as structs of ``order``.

    Only keys and order columns are shuffled. Where ``order`` is unique within a key,
    ``order >= _test`` and ``order < _train_end`` mark the same rows as
    ``chronological_split``.
    """
    o = ordered(df.select(*keys, *order), keys, order, limit=limit)
    cut = F.floor(o.size.cast("double") * F.lit(float(share)))
    placed = o.finish(o.frame.select("*", (o.position - cut).alias("_from_cut")))
    here = F.struct(*order)
    return placed.filter(F.col("_from_cut").isin(0, -embargo)).groupBy(*keys).agg(
        F.max(F.when(F.col("_from_cut") == 0, here)).alias("_test"),
        F.max(F.when(F.col("_from_cut") == -embargo, here)).alias("_train_end"))


def newest(
    df: DataFrame, n: int | None = 1000, keys: Sequence[str] = (), order: Sequence[str] = (S.TIME,)
) -> DataFrame:
    """The ``n`` newest rows, overall or per key; all rows if ``n`` is None."""
    if n is None:
        return df
    latest_first = [F.desc(c) for c in order]
    if not keys:
        return df.orderBy(*latest_first).limit(n)
    # a rank filter like this is applied on the map side before the shuffle
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def latest_change(
    df: DataFrame,
    value: str = "aqi",
    keys: Sequence[str] = S.KEYS,
    order: Sequence[str] = (S.TIME,),
) -> DataFrame:
    """Newest value per key, its time, its change to the row before, and the row count."""
    two = newest(df.select(*keys, *order, value), 2, keys, order)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    ranked = two.withColumn("_rank", rank)
    first, second = F.col("_rank") == 1, F.col("_rank") == 2
    ends = ranked.groupBy(*keys).agg(
        F.max(F.when(first, F.col(order[0]))).alias("as_of"),
        F.max(F.when(first, F.col(value))).alias("current"),
        F.max(F.when(second, F.col(value))).alias("_previous"),
    ).select(*keys, "as_of", "current", (F.col("current") - F.col("_previous")).alias("change"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("data_points"))
    return ends.join(counts, list(keys))


def last_days(df: DataFrame, days: int = 7, time: str = S.TIME) -> DataFrame:
    """Rows of the last ``days`` days before the newest row."""
    # the bound becomes a literal, so the filter reaches a Parquet scan
    end = df.agg(F.max(time).cast("string")).first()[0]
    first = F.lit(end).cast(df.schema[time].dataType) - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(time) >= first)


def hourly_series(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = S.KEYS,
    time: str = S.TIME,
    smooth: str | None = "aqi",
    smooth_rows: int = 6,
    segment: str = "month",
) -> DataFrame:
    """Hourly means on a gap-free calendar, gaps filled along a straight line.

    Before the first and after the last value the nearest value is kept. ``smooth``
    adds the mean of the last ``smooth_rows`` hours of one column, which must be fewer than a segment has.

    The work is cut into segments of a key's calendar ("day", "month"), so neither a long key nor one absurd time is one task
    or one array: each segment makes its own hours and knows its own first and last values. A second level, a row
    for each segment, carries the nearest values over the borders. Rows without a time are left out.
    """
    keys = list(keys)
    hour = F.date_trunc("hour", F.col(time).cast("timestamp"))
    means = df.filter(F.col(time).isNotNull()).groupBy(*keys, hour.alias(time)).agg(*[F.avg(c).alias(c) for c in columns])
    means = durable(means.withColumn("_segment", F.date_trunc(segment, time)), "hours")
    length, step = F.expr(f"interval 1 {segment}"), F.expr("interval 1 hour")

    # per segment that has rows: its ends, and per column the first and last value with their times
    seconds = F.unix_timestamp(time)
    point = {c: F.when(F.col(c).isNotNull(), F.struct(seconds.alias("t"), F.col(c).alias("v"))) for c in columns}
    states = durable(means.groupBy(*keys, "_segment").agg(
        F.min(time).alias("_low"), F.max(time).alias("_high"),
        *[F.min(p).alias(f"_f_{c}") for c, p in point.items()], *[F.max(p).alias(f"_l_{c}") for c, p in point.items()]), "states")
    ends = durable(states.groupBy(*keys).agg(F.min("_low").alias("_from"), F.max("_high").alias("_to")), "ends")
    every = ends.withColumn("_segment", F.explode(F.sequence(F.date_trunc(segment, "_from"), F.date_trunc(segment, "_to"), length)))
    by_segment = Window.partitionBy(*keys)
    before = by_segment.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    after = by_segment.orderBy(F.desc("_segment")).rowsBetween(Window.unboundedPreceding, -1)
    first_hour, last_hour = F.greatest("_from", "_segment"), F.least("_to", F.col("_segment") + length - step)
    borders = durable(every.join(states, [*keys, "_segment"], "left").select(
        *keys, "_segment", F.col("_low").isNull().alias("_empty"), first_hour.alias("_start"), last_hour.alias("_end"),
        *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_b_{c}") for c in columns],
        *[F.last(f"_f_{c}", ignorenulls=True).over(after).alias(f"_a_{c}") for c in columns]), "borders")

    # every row makes the hours up to the next one; the first and the last also those to the segment's ends
    window = Window.partitionBy(*keys, "_segment").orderBy(time)
    previous, following = F.lag(time).over(window), F.lead(time).over(window)
    placed = means.join(small_side(borders.select(*keys, "_segment", "_start", "_end")), [*keys, "_segment"]).repartition(*keys, "_segment")
    spans = placed.withColumns({"_p": previous, "_n": following})
    begin = F.when(F.col("_p").isNull(), F.col("_start")).otherwise(F.col(time))
    finish = F.when(F.col("_n").isNull(), F.col("_end")).otherwise(F.col("_n") - step)
    hours = F.explode(F.sequence(begin, finish, step)).alias("_h")
    own = F.col("_h") == F.col(time)
    grid = spans.select(*keys, "_segment", time, *columns, hours).select(
        *keys, "_segment", F.col("_h").alias(time), *[F.when(own, F.col(c)).alias(c) for c in columns])
    # known so far in the segment, from either side
    seen = window.rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*keys, "_segment").orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
    known = grid.select(
        "*", *[F.last(p, ignorenulls=True).over(seen).alias(f"_l_{c}") for c, p in point.items()],
        *[F.last(p, ignorenulls=True).over(back).alias(f"_r_{c}") for c, p in point.items()])
    nothing = borders.filter("_empty").select(*keys, "_segment", F.explode(F.sequence("_start", "_end", step)).alias(time))
    nothing = nothing.select("*", *[F.lit(None).cast(known.schema[n].dataType).alias(n) for n in known.columns[len(keys) + 2:]])

    def filled(c: str):
        left, right = F.coalesce(f"_l_{c}", f"_b_{c}"), F.coalesce(f"_r_{c}", f"_a_{c}")
        line = left.v + (right.v - left.v) * (seconds - left.t) / (right.t - left.t)
        return F.coalesce(
            F.col(c), F.when(left.isNotNull() & right.isNotNull(), line), left.v, right.v).alias(c)

    carried = small_side(borders.select(*keys, "_segment", *[f"_{side}_{c}" for side in "ba" for c in columns]))
    series = known.unionByName(nothing).join(carried, [*keys, "_segment"]).select(*keys, "_segment", time, *[filled(c) for c in columns])
    if smooth not in columns:
        return series.drop("_segment")
    return _smoothed(durable(series, "series"), keys, time, smooth, smooth_rows, length).drop("_segment")


def _smoothed(series: DataFrame, keys: Sequence[str], time: str, column: str, rows: int, length) -> DataFrame:
    """Add the mean of the last ``rows`` hours; the last hours of each segment are handed to the next one."""
    window = Window.partitionBy(*keys, "_segment").orderBy(time)
    late = F.unix_timestamp(time) > F.unix_timestamp(F.col("_segment") + length) - 3600 * rows
    tails = series.filter(late).groupBy(*keys, (F.col("_segment") + length).alias("_segment")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(time, column))), lambda p: p[column].cast("double")).alias("_tail"))  # fewer than ``rows``
    frame = window.rowsBetween(1 - rows, 0)
    here = series.withColumns({"_i": F.row_number().over(window), "_sum": F.sum(column).over(frame), "_n": F.count(column).over(frame)})
    joined = here.join(small_side(tails), [*keys, "_segment"], "left")
    missing = F.greatest(F.lit(0), F.lit(rows) - F.col("_i"))
    tail = F.coalesce("_tail", F.array().cast("array<double>"))
    taken = F.filter(F.when(missing >= F.size(tail), tail).otherwise(F.slice(tail, F.size(tail) - missing + 1, missing)), lambda v: v.isNotNull())
    total = F.coalesce("_sum", F.lit(0.0)) + F.aggregate(taken, F.lit(0.0), lambda a, v: a + v)
    count = F.col("_n") + F.size(taken)
    return joined.withColumn(f"{column}_smooth", F.when(count > 0, total / count)).drop("_i", "_sum", "_n", "_tail")


def daily_means(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = S.KEYS, time: str = S.TIME
) -> DataFrame:
    """Long table of key, column, day, mean; days without any value are absent."""
    day = F.to_date(F.col(time).cast("timestamp"))
    wide = df.groupBy(*keys, day.alias("day")).agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([*keys, "day"], list(columns), "column", "mean").filter(
        F.col("mean").isNotNull())


def daily_trend(daily: DataFrame, keys: Sequence[str] = S.KEYS) -> DataFrame:
    """Mean, deviation and least-squares slope per day of a daily series."""
    index = F.unix_date("day").cast("double")
    out = daily.groupBy(*keys, "column").agg(
        F.avg("mean").alias("daily_mean"),
        F.stddev_samp("mean").alias("daily_std"),
        F.covar_pop("mean", index).alias("_cov"),
        F.var_pop(index).alias("_var"))
    slope = F.col("_cov") / F.nullif(F.col("_var"), F.lit(0.0))
    return (out.withColumn("trend_slope", slope)
            .withColumn("trend", F.when(slope.isNotNull(), F.when(slope > 0, "Increasing")
                                        .otherwise("Decreasing")))
            .drop("_cov", "_var"))


def seasonality(
    daily: DataFrame,
    keys: Sequence[str] = S.KEYS,
    lag_days: int = 7,
    least_days: int = 30,
    threshold: float = 0.3,
) -> DataFrame:
    """Autocorrelation of a daily series with itself ``lag_days`` earlier.

    The lag is in calendar days, so an absent day pairs with nothing. Fewer than
    ``least_days`` days, first to last, are never seasonal.
    """
    index = F.unix_date("day")
    by_day = Window.partitionBy(*keys, "column").orderBy(index)
    earlier = F.max("mean").over(by_day.rangeBetween(-lag_days, -lag_days))
    paired = daily.withColumn("_earlier", earlier)
    out = paired.groupBy(*keys, "column").agg(
        (F.max(index) - F.min(index) + 1).cast("int").alias("days"),
        pearson(F.col("mean"), F.col("_earlier")).alias("autocorr"))
    long_enough = F.col("days") >= least_days
    return out.withColumn(
        "seasonal", F.coalesce(long_enough & (F.abs("autocorr") > threshold), F.lit(False)))
