"""Checked queries: index, calendar, derived, lag, rolling and target columns."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.checks import views as V
from skygrain.functions import index, weather
from skygrain.functions.calendar import calendar_columns
from skygrain.operators import features as FE
from skygrain.operators.ordered import GROUP_LIMIT, ordered

BACK = max(S.ROLLING_WINDOWS) - 1
# Every city of the test tables has more rows than this, so the queries that take it as limit cut their groups.
CUT = 200


def aqi_units(spark, sf):
    return index.with_units(V.obs(spark, sf)).select("event_id", *index.UNITS)


def _sub_indices(spark, sf, policy):
    df = index.with_units(V.obs(spark, sf))
    return df.select("event_id", *[c.alias(n) for n, c in index.sub_indices(df, policy).items()])


def aqi_subindex(spark, sf):
    return _sub_indices(spark, sf, "cap")


def aqi_subindex_truncated(spark, sf):
    return _sub_indices(spark, sf, "truncate")


def aqi_overall(spark, sf):
    return index.with_aqi(V.obs_null(spark, sf)).select("event_id", "aqi")


def aqi_by_category(spark, sf):
    df = V.obs_aqi(spark, sf).select("city", "aqi", index.category(F.col("aqi")).alias("c"))
    return df.groupBy("city", "c.category", "c.level", "c.color", "c.message").agg(
        F.count(F.lit(1)).alias("n"), F.max("aqi").alias("max_aqi"))


def gauge_level(spark, sf):
    df = V.obs_aqi(spark, sf).select("aqi", index.gauge(F.col("aqi")).alias("g"))
    return df.groupBy("g.level", "g.color").agg(
        F.count(F.lit(1)).alias("n"), F.min("aqi").alias("lowest"), F.max("aqi").alias("highest"))


def calendar_features(spark, sf):
    columns = calendar_columns(F.col("timestamp"))
    return V.obs(spark, sf).select("event_id", *[
        (F.round(c, 6) if n.endswith(("sin", "cos")) else c).alias(n) for n, c in columns.items()])


def derived_features(spark, sf):
    df = V.obs_aqi(spark, sf)
    o = ordered(df, ["city"], V.ORDER, back=1)
    named = {**weather.derived_columns(df), **FE.change_column(o.window)}
    return o.finish(o.frame.select("*", *[
        (F.round(c, 6) if n in ("wind_chill", "pm_ratio") else c).alias(n)
        for n, c in named.items()])).select("event_id", *named)


def lag_features(spark, sf, limit=GROUP_LIMIT):
    o = ordered(V.obs_aqi(spark, sf), ["city"], V.ORDER, back=max(S.LAG_HOURS), limit=limit)
    named = FE.lag_columns(S.LAG_COLUMNS, o.window)
    return o.finish(o.frame.select("*", *[c.alias(n) for n, c in named.items()])).select(
        "event_id", *named)


def _rolling(spark, sf, stat, finish, limit=GROUP_LIMIT):
    # rows go through Python whole, so columns nobody asks for are left out before
    df = V.obs_aqi(spark, sf).select("city", *V.ORDER, *S.ROLLING_COLUMNS)
    o = ordered(df, ["city"], V.ORDER, back=BACK, limit=limit)
    df = o.finish(FE.with_rolling(o.frame, S.ROLLING_COLUMNS, o.window, stats=(stat,)))
    names = [S.rolling_name(c, stat, w) for c in S.ROLLING_COLUMNS for w in S.ROLLING_WINDOWS]
    return df.select("event_id", *[finish(F.col(n)).alias(n) for n in names])


def rolling_mean(spark, sf):
    return _rolling(spark, sf, "mean", lambda c: c)


def rolling_std(spark, sf, limit=GROUP_LIMIT):
    return _rolling(spark, sf, "std", lambda c: F.round(c, 6), limit)


def rolling_with_missing(spark, sf):
    """Rolling mean and deviation where readings are missing."""
    o = ordered(V.obs_null(spark, sf), ["city"], V.ORDER, back=BACK)
    df = o.finish(FE.with_rolling(o.frame, ["pm2_5", "ozone"], o.window))
    names = [S.rolling_name(c, s, w) for c in ("pm2_5", "ozone")
             for w in S.ROLLING_WINDOWS for s in ("mean", "std")]
    return df.select("event_id", *[
        (F.round(n, 6) if "_std_" in n else F.col(n)).alias(n) for n in names])


def target_6h(spark, sf):
    o = ordered(V.obs_aqi(spark, sf), ["city"], V.ORDER, ahead=S.TARGET_HOURS)
    return o.finish(o.frame.select(
        "*", F.lead("aqi", S.TARGET_HOURS).over(o.window).alias(S.TARGET))).select(
        "event_id", "aqi", S.TARGET)


def targets_multi(spark, sf, limit=GROUP_LIMIT):
    df = FE.with_targets(V.obs_aqi(spark, sf), ["city"], V.ORDER, limit=limit)
    return df.select("event_id", *[S.horizon_name(h) for h in S.HORIZONS])


HOURLY = ["timestamp", "event_id"]
# Fewer rows than any city has hours with a reading.
CUT_HOURS = 40


def lag_features_aligned(spark, sf, limit=GROUP_LIMIT):
    """Lags by the clock where hours are missing."""
    df, by = FE.aligned_order(index.with_aqi(V.hourly(spark, sf)), HOURLY)
    o = ordered(df, ["city"], by, limit=limit, back_range=float(max(S.LAG_HOURS) * FE.HOUR))
    named = FE.aligned_shifts(FE.by_time(o), HOURLY[1:], S.LAG_COLUMNS)
    return o.finish(o.frame.select("*", *[c.alias(n) for n, c in named.items()])).select("city", "timestamp", *named)


def rolling_aligned(spark, sf, limit=GROUP_LIMIT):
    """Rolling statistics over hours by the clock, readings at any time and some missing."""
    df, by = FE.aligned_order(index.with_aqi(V.obs_null(spark, sf)), V.ORDER)
    df = df.select("city", *by, *S.ROLLING_COLUMNS)
    o = ordered(df, ["city"], by, limit=limit, back_range=float(max(S.ROLLING_WINDOWS) * FE.HOUR))
    df = o.finish(FE.with_aligned_rolling(o.frame, S.ROLLING_COLUMNS, FE.by_time(o)))
    names = [S.rolling_name(c, s, w) for c in S.ROLLING_COLUMNS for w in S.ROLLING_WINDOWS for s in ("mean", "std")]
    return df.select("event_id", *[(F.round(n, 6) if "_std_" in n else F.col(n)).alias(n) for n in names])


def targets_aligned(spark, sf, limit=GROUP_LIMIT):
    """Rows whose index is known 1, 6, 12, 24, 48 and 72 hours later."""
    df = FE.with_targets(index.with_aqi(V.hourly(spark, sf)), ["city"], HOURLY, limit=limit, align="time")
    return df.select("city", "timestamp", *[S.horizon_name(h) for h in S.HORIZONS])


def _every_column(df):
    """Number and sum of every lag, rolling and target column per city."""
    names = [c for c in df.columns if "_lag_" in c or "_rolling_" in c or c.startswith("aqi_h")]
    return [e for c in names for e in (F.count(c).alias(f"n_{c}"), F.round(F.sum(c), 3).alias(f"sum_{c}"))]


def engineered_aligned(spark, sf, limit=GROUP_LIMIT):
    """The whole feature table by the clock with all targets, every column summed up per city."""
    df = FE.engineer(V.hourly(spark, sf), ["city"], HOURLY, limit=limit, align="time", horizons=S.HORIZONS)
    return df.groupBy("city").agg(
        F.count(F.lit(1)).alias("n"), F.count(S.TARGET).alias("with_target"), F.sum(S.TARGET).alias("sum_target"),
        F.sum("aqi_change_1h").alias("sum_change"), *_every_column(df))


def engineered_features(spark, sf):
    """The whole feature table from one plan, every column summed up per city."""
    df = FE.engineer(V.obs(spark, sf), ["city"], V.ORDER)
    return df.groupBy("city").agg(
        *_every_column(df),
        F.count(F.lit(1)).alias("n"),
        F.count(S.TARGET).alias("with_target"),
        F.sum("aqi_lag_6h").alias("sum_lag"),
        F.round(F.sum("pm10_rolling_mean_24h"), 3).alias("sum_mean"),
        F.round(F.sum("pm10_rolling_std_48h"), 3).alias("sum_std"),
        F.max("aqi_change_1h").alias("max_change"),
        F.round(F.max("wind_chill"), 6).alias("max_chill"))


def feature_complete_rows(spark, sf):
    df = FE.complete_rows(FE.engineer(V.obs_null(spark, sf), ["city"], V.ORDER))
    return df.select("event_id", "aqi", "pm2_5_lag_6h", "ozone_lag_1h", S.TARGET)


QUERIES = {f.__name__: f for f in (
    aqi_units, aqi_subindex, aqi_subindex_truncated, aqi_overall, aqi_by_category, gauge_level,
    calendar_features, derived_features, lag_features, rolling_mean, rolling_std,
    rolling_with_missing, target_6h, targets_multi, engineered_features, feature_complete_rows,
    lag_features_aligned, rolling_aligned, targets_aligned, engineered_aligned)}
CUTS = (lag_features, rolling_std, targets_multi, rolling_aligned)
HOUR_CUTS = (lag_features_aligned, targets_aligned, engineered_aligned)
QUERIES |= {f"{f.__name__}_cut": partial(f, limit=CUT) for f in CUTS}
QUERIES |= {f"{f.__name__}_cut": partial(f, limit=CUT_HOURS) for f in HOUR_CUTS}


# --- SQL twins -------------------------------------------------------------------

def _case(column: str, bands, cut: float | None = None) -> str:
    c = column if cut is None else f"(floor({column} * {cut} + 1e-9) / {cut})"
    whens = " ".join(
        f"when {c} >= {lo}::double and {c} <= {hi}::double then "
        f"round_even({(ih - il) / (hi - lo)!r}::double * ({c} - {lo}::double) + {il}::double, 0)"
        for lo, hi, il, ih in bands)
    return f"case when {c} is null or {c} < 0 then null {whens} else 500::double end"


def _sub_sql(truncate: bool = False) -> dict[str, str]:
    return {n: _case(c, bands, float(10 ** d) if truncate else None)
            for n, (c, bands, d) in index.SUB_INDICES.items()}


UNITS_SQL = ", ".join(f"{src} / {div!r}::double as {n}" for n, (src, div) in index.UNITS.items())


def aqi_sql(name: str, source: str) -> str:
    """CTEs ``<name>_units`` and ``<name>``: a view plus converted units and aqi."""
    top = "greatest(" + ", ".join(_sub_sql().values()) + ")"
    return (f"{name}_units as (select *, {UNITS_SQL} from {source}), "
            f"{name} as (select *, cast({top} as int) as aqi from {name}_units)")


W = "partition by city order by timestamp, event_id"
OBS = f"with {V.OBS_SQL}, {aqi_sql('o', 'obs')}"
NULLS = f"with {V.OBS_SQL}, {aqi_sql('o', 'obs_null')}"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ladder(value: str, steps: list[tuple]) -> str:
    whens = " ".join(f"when {value} <= {b} then {t}" for b, t in steps[:-1])
    return f"case {whens} else {steps[-1][1]} end"


def _category(position: int) -> str:
    return ladder("aqi", [
        (c[0], quoted(c[position]) if isinstance(c[position], str) else str(c[position]))
        for c in index.CATEGORIES])


def _lags() -> str:
    return ", ".join(f"lag({c}, {k}) over ({W}) as {S.lag_name(c, k)}"
                     for c in S.LAG_COLUMNS for k in S.LAG_HOURS)


def _rolls(columns, stats=("mean", "std"), digits=True) -> str:
    out = []
    for c in columns:
        for w in S.ROLLING_WINDOWS:
            frame = f"over ({W} rows between {w - 1} preceding and current row)"
            if "mean" in stats:
                out.append(f"avg({c}) {frame} as {S.rolling_name(c, 'mean', w)}")
            if "std" in stats:
                std = f"stddev_samp({c}) {frame}"
                out.append(f"{f'round({std}, 6)' if digits else std} as {S.rolling_name(c, 'std', w)}")
    return ", ".join(out)


CHILL = ("13.12 + 0.6215::double * temperature_2m - 11.37::double * pow(wind_speed_10m, 0.16::double)"
         " + 0.3965::double * temperature_2m * pow(wind_speed_10m, 0.16::double)")
TWO_PI = "(2 * pi())"


def _cycle(name: str, value: str, n: int) -> str:
    return (f"round(sin({TWO_PI} * {value} / {n}), 6) as {name}_sin, "
            f"round(cos({TWO_PI} * {value} / {n}), 6) as {name}_cos")


def _complete() -> str:
    names = [*V.MEASURES, *index.UNITS, "aqi", "aqi_change_1h", S.TARGET,
             *[S.lag_name(c, k) for c in S.LAG_COLUMNS for k in S.LAG_HOURS],
             *[S.rolling_name(c, s, w) for c in S.ROLLING_COLUMNS
               for w in S.ROLLING_WINDOWS for s in ("mean", "std")]]
    return " and ".join(f"{n} is not null" for n in names)


FULL = (f"select *, aqi - lag(aqi, 1) over ({W}) as aqi_change_1h, {_lags()}, "
        f"{_rolls(S.ROLLING_COLUMNS, digits=False)}, "
        f"lead(aqi, {S.TARGET_HOURS}) over ({W}) as {S.TARGET} from o")

# by the clock: a value at an exact earlier or later time, and frames of so many hours
ALIGNED = f"with {V.OBS_SQL}, {aqi_sql('o', 'hourly')}, {aqi_sql('p', 'obs_null')}"


def _at_hours(column: str, hours: int) -> str:
    side = "preceding" if hours < 0 else "following"
    reach = f"interval {abs(hours)} hour {side}"
    return (f"max({column}) over (partition by city order by timestamp range between {reach} and {reach})")


def _aligned_lags() -> dict[str, str]:
    return {S.lag_name(c, k): _at_hours(c, -k) for c in S.LAG_COLUMNS for k in S.LAG_HOURS}


def _aligned_rolls(digits: int | None = None) -> dict[str, str]:
    out = {}
    for c in S.ROLLING_COLUMNS:
        for w in S.ROLLING_WINDOWS:
            frame = f"over (partition by city order by timestamp range between interval {w * 3_600_000_000 - 1} microsecond preceding and current row)"
            out[S.rolling_name(c, "mean", w)] = f"avg({c}) {frame}"
            std = f"stddev_samp({c}) {frame}"
            out[S.rolling_name(c, "std", w)] = f"round({std}, {digits})" if digits else std
    return out


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in columns.items())


def _sums(names) -> str:
    return ", ".join(f"count({c}) as n_{c}, round(sum({c}), 3) as sum_{c}" for c in names)


_ALIGNED_TARGETS = {S.horizon_name(h): _at_hours("aqi", h) for h in S.HORIZONS}
_ROW_COLUMNS = [*[S.rolling_name(c, s, w) for c in S.ROLLING_COLUMNS for w in S.ROLLING_WINDOWS for s in ("mean", "std")],
                *[S.lag_name(c, k) for c in S.LAG_COLUMNS for k in S.LAG_HOURS]]

ORACLES = {
    "lag_features_aligned": f"{ALIGNED} select city, timestamp, {_named(_aligned_lags())} from o",
    "rolling_aligned": f"{ALIGNED} select event_id, {_named(_aligned_rolls(6))} from p",
    "targets_aligned": f"{ALIGNED} select * from (select city, timestamp, {_named(_ALIGNED_TARGETS)} from o) where "
                       + " and ".join(f"{n} is not null" for n in _ALIGNED_TARGETS),
    "engineered_aligned": f"""{ALIGNED}, f as (select city, aqi - {_at_hours('aqi', -1)} as change, {_at_hours('aqi', S.TARGET_HOURS)} as target,
        {_named(_aligned_lags())}, {_named(_aligned_rolls())}, {_named(_ALIGNED_TARGETS)} from o)
        select city, count(*) as n, count(target) as with_target, cast(sum(target) as bigint) as sum_target,
        cast(sum(change) as bigint) as sum_change, {_sums([*_ROW_COLUMNS, *_ALIGNED_TARGETS])} from f group by city""",
    "aqi_units": f"with {V.OBS_SQL} select event_id, {UNITS_SQL} from obs",
    "aqi_subindex": f"{OBS} select event_id, "
                    + ", ".join(f"{x} as {n}" for n, x in _sub_sql().items()) + " from o_units",
    "aqi_subindex_truncated": f"{OBS} select event_id, "
                    + ", ".join(f"{x} as {n}" for n, x in _sub_sql(True).items()) + " from o_units",
    "aqi_overall": f"{NULLS} select event_id, aqi from o",
    "aqi_by_category": f"""{OBS} select city, {_category(1)} as category,
        cast({_category(2)} as int) as level, {_category(3)} as color, {_category(4)} as message,
        count(*) as n, max(aqi) as max_aqi from o group by 1, 2, 3, 4, 5""",
    "gauge_level": f"""{OBS} select {_category(1)} as level,
        {ladder('aqi', [(b, quoted(c)) for b, c in index.GAUGE])} as color,
        count(*) as n, min(aqi) as lowest, max(aqi) as highest from o group by 1, 2""",
    "calendar_features": f"""with {V.OBS_SQL}, p as (
        select event_id, cast(hour(timestamp) as int) as hour,
          cast(isodow(timestamp) - 1 as int) as day_of_week, cast(month(timestamp) as int) as month
        from obs)
        select *, cast(day_of_week in (5, 6) as int) as is_weekend,
          cast(hour in (7, 8, 17, 18) as int) as is_rush_hour,
          case when month in (12, 1, 2) then 0 when month in (3, 4, 5) then 1
               when month in (6, 7, 8) then 2 else 3 end as season,
          {_cycle('hour', 'hour', 24)}, {_cycle('dow', 'day_of_week', 7)}, {_cycle('month', 'month', 12)}
        from p""",
    "derived_features": f"""{OBS} select event_id,
        temperature_2m * relative_humidity_2m as temp_humidity_interaction,
        round({CHILL}, 6) as wind_chill, round(pm2_5 / (pm10 + 1e-6), 6) as pm_ratio,
        pm2_5 + pm10 as pm_combined, aqi - lag(aqi) over ({W}) as aqi_change_1h from o""",
    "lag_features": f"{OBS} select event_id, {_lags()} from o",
    "rolling_mean": f"{OBS} select event_id, {_rolls(S.ROLLING_COLUMNS, ('mean',))} from o",
    "rolling_std": f"{OBS} select event_id, {_rolls(S.ROLLING_COLUMNS, ('std',))} from o",
    "rolling_with_missing": f"{NULLS} select event_id, {_rolls(['pm2_5', 'ozone'])} from o",
    "target_6h": f"{OBS} select event_id, aqi, lead(aqi, 6) over ({W}) as {S.TARGET} from o",
    "targets_multi": f"""{OBS} select * from (select event_id, """
                     + ", ".join(f"lead(aqi, {h}) over ({W}) as {S.horizon_name(h)}" for h in S.HORIZONS)
                     + " from o) where " + " and ".join(f"{S.horizon_name(h)} is not null" for h in S.HORIZONS),
    "engineered_features": f"""{OBS}, f as ({FULL}) select city, {_sums(_ROW_COLUMNS)}, count(*) as n,
        count({S.TARGET}) as with_target, cast(sum(aqi_lag_6h) as bigint) as sum_lag,
        round(sum(pm10_rolling_mean_24h), 3) as sum_mean,
        round(sum(pm10_rolling_std_48h), 3) as sum_std,
        max(aqi_change_1h) as max_change, round(max({CHILL}), 6) as max_chill
        from f group by city""",
    "feature_complete_rows": f"""{NULLS}, f as ({FULL})
        select event_id, aqi, pm2_5_lag_6h, ozone_lag_1h, {S.TARGET} from f where {_complete()}""",
}
ORACLES |= {f"{f.__name__}_cut": ORACLES[f.__name__] for f in (*CUTS, *HOUR_CUTS)}
