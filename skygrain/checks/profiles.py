"""Checked queries: series operators and the data profile."""

from __future__ import annotations

import uuid
from functools import partial
from itertools import combinations

from pyspark.sql import functions as F

from skygrain.checks import views as V
from skygrain.checks.features import CUT, OBS, W
from skygrain.operators import profile as P
from skygrain.operators import profile_state as PS
from skygrain.operators import selection
from skygrain.operators import series as T
from skygrain.operators.ordered import GROUP_LIMIT
from skygrain.operators.quantiles import quantiles
from skygrain.session import scratch_root

COLUMNS = [*V.MEASURES, "latitude", "longitude", "aqi"]
SERIES = ["aqi", *V.MEASURES]


def _r(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def chrono_split(spark, sf, limit=GROUP_LIMIT):
    return T.chronological_split(V.obs(spark, sf), ["city"], V.ORDER, limit=limit).select("event_id", "split")


def chrono_split_embargo(spark, sf):
    return T.chronological_split(V.obs(spark, sf), ["city"], V.ORDER, embargo=72).select(
        "event_id", "split")


def latest_change(spark, sf):
    return T.latest_change(V.obs_aqi(spark, sf), "aqi", ["city"], V.ORDER)


def hourly_resample_smooth(spark, sf, segment="month"):
    series = T.hourly_series(V.obs_aqi(spark, sf), SERIES, segment=segment)
    return _r(_r(series, *SERIES, digits=9), "aqi_smooth")


def seasonality(spark, sf):
    daily = T.daily_means(V.daily_orders(spark, sf), ["quantity", "line"])
    return _r(T.seasonality(daily), "autocorr")


def daily_trend(spark, sf):
    daily = T.daily_means(V.daily_orders(spark, sf), ["quantity", "line"])
    return _r(T.daily_trend(daily), "daily_mean", "daily_std", digits=6).withColumn(
        "trend_slope", F.round("trend_slope", 9))


def last_week(spark, sf):
    return T.last_days(V.obs(spark, sf), 7).select("event_id", "timestamp")


def analysis_period(spark, sf):
    return P.analysis_period(V.obs(spark, sf))


def overview(spark, sf):
    return P.overview(V.obs_aqi(spark, sf).drop("event_type", "event_id"))


def describe(spark, sf, limit=GROUP_LIMIT):
    return _r(P.describe(V.obs_aqi(spark, sf), COLUMNS, limit), "mean", "std", "p25", "p50", "p75")


def distributions(spark, sf, limit=GROUP_LIMIT):
    return _r(P.distributions(V.obs_aqi(spark, sf), COLUMNS, limit), "mean", "std", "skewness",
              "kurtosis", "median", "p25", "p75", "p90", "p95")


def outliers(spark, sf, limit=GROUP_LIMIT):
    return _r(P.outliers(V.obs_aqi(spark, sf), COLUMNS, ["event_id"], limit=limit),
              "lower", "upper")


def outlier_counts(spark, sf, limit=GROUP_LIMIT):
    return _r(P.outlier_counts(V.obs_aqi(spark, sf), COLUMNS, ["city"], limit),
              "q1", "q3", "lower", "upper")


def corr_matrix(spark, sf):
    return _r(P.correlation_matrix(V.obs_aqi(spark, sf), COLUMNS), "correlation")


def strong_corr(spark, sf):
    return _r(P.strong_correlations(P.correlation_pairs(V.obs_aqi(spark, sf), COLUMNS)), "correlation")


def top_corr(spark, sf):
    return _r(P.top_correlations(P.target_correlations(V.obs_aqi(spark, sf), COLUMNS)), "correlation")


def missing_data(spark, sf):
    return _r(P.missing_by_column(V.obs_null(spark, sf)), "percentage")


def missing_total(spark, sf):
    return _r(P.missing_total(V.obs_null(spark, sf)), "missing_percentage")


def histogram(spark, sf):
    return _r(P.histogram(V.obs(spark, sf), V.MEASURES), "bin_from", "bin_to")


SHARES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q72": 0.72, "q95": 0.95}


def quantiles_special(spark, sf, limit=GROUP_LIMIT):
    """Quantiles per city of values of which a third is infinite or no number."""
    kind = F.col("event_id") % 9
    v = (F.when(kind == 0, float("inf")).when(kind == 3, float("-inf")).when(kind == 6, float("nan")).otherwise(F.col("pm10")))
    q = quantiles(V.obs(spark, sf).select("city", v.alias("v")), ["city"], "v", list(SHARES.values()), limit)
    bounded = lambda c: F.when(~F.isnan(c), F.greatest(F.lit(-1e300), F.least(F.lit(1e300), c)))
    return q.select("city", *[F.round(bounded(F.col("quantiles")[i]), 9).alias(n) for i, n in enumerate(SHARES)])


def sorted_positions(spark, sf):
    """The place of every row in the order by reading, highest first, and event."""
    return selection.sorted_table(V.obs(spark, sf), [F.desc("pm10"), F.col("event_id")]).select("event_id", "pm10", "position")


def _merged(spark, sf, source, columns):
    """States of two halves of the months' rows: the first half, then all rows of the months that the second changes."""
    df = source.withColumn(PS.PERIOD, F.date_format("timestamp", "yyyy-MM-dd"))  # short months: a day each
    path = f"{scratch_root(spark)}/states-{uuid.uuid4().hex}"
    first = df.filter("event_id % 3 <> 0 or timestamp < timestamp '2024-01-16'")
    centre = PS.centres(first, columns)
    PS.write_states(PS.states(first, columns, centre), path)
    PS.write_states(PS.states(df.filter("timestamp >= timestamp '2024-01-16'"), columns, centre), path)
    return PS.read_states(spark, path), centre


def profile_merged(spark, sf):
    """The distributions of all columns from stored states of days, half of them replaced by later ones."""
    found, centre = _merged(spark, sf, V.obs_aqi(spark, sf), COLUMNS)
    return _r(PS.distributions(found, centre), "mean", "std", "skewness", "kurtosis", "median", "p25", "p75", "p90", "p95")


def corr_matrix_merged(spark, sf):
    found, _ = _merged(spark, sf, V.obs_aqi(spark, sf), COLUMNS)
    return _r(PS.correlation_matrix(found, COLUMNS), "correlation")


def missing_merged(spark, sf):
    found, _ = _merged(spark, sf, V.obs_null(spark, sf), V.MEASURES)
    return _r(PS.missing_by_column(found), "percentage")


QUERIES = {f.__name__: f for f in (
    profile_merged, corr_matrix_merged, missing_merged, quantiles_special, sorted_positions, chrono_split, chrono_split_embargo, latest_change, hourly_resample_smooth, seasonality,
    daily_trend, last_week, analysis_period, overview, describe, distributions, outliers,
    outlier_counts, corr_matrix, strong_corr, top_corr, missing_data, missing_total, histogram)}
CUTS = (quantiles_special, chrono_split, describe, distributions, outliers, outlier_counts)
QUERIES |= {f"{f.__name__}_cut": partial(f, limit=CUT) for f in CUTS}
QUERIES["hourly_resample_smooth_cut"] = partial(hourly_resample_smooth, segment="day")


# --- SQL twins -------------------------------------------------------------------

def _unpivot(source: str, columns, keys=()) -> str:
    head = "".join(f"{k}, " for k in keys)
    return " union all ".join(
        f"select {head}'{c}' as \"column\", cast({c} as double) as value from {source} where {c} is not null"
        for c in columns)


def _filled(c: str) -> str:
    l, r = f"l_{c}", f"r_{c}"
    return (f"coalesce({c}, case when {l} is not null and {r} is not null then "
            f"{l}.v + ({r}.v - {l}.v) * (epoch(timestamp) - {l}.t) / ({r}.t - {l}.t) end, {l}.v, {r}.v)")


def _near(c: str) -> str:
    point = f"case when {c} is not null then {{'t': epoch(timestamp), 'v': {c}}} end"
    w = "partition by city order by timestamp rows between"
    return (f"last_value({point} ignore nulls) over ({w} unbounded preceding and current row) as l_{c}, "
            f"first_value({point} ignore nulls) over ({w} current row and unbounded following) as r_{c}")


HOURLY = f"""{OBS}, h as (
    select city, date_trunc('hour', timestamp) as timestamp, {', '.join(f'avg({c}) as {c}' for c in SERIES)}
    from o group by 1, 2),
  cal as (select city, unnest(generate_series(min(timestamp), max(timestamp), interval 1 hour)) as timestamp
    from h group by city),
  g as (select cal.city, cal.timestamp, {', '.join(SERIES)} from cal left join h using (city, timestamp)),
  n as (select *, {', '.join(_near(c) for c in SERIES)} from g),
  f as (select city, timestamp, {', '.join(f'{_filled(c)} as {c}' for c in SERIES)} from n)
  select city, timestamp, {', '.join(f'round({c}, 9) as {c}' for c in SERIES)},
    round(avg(aqi) over (partition by city order by timestamp rows between 5 preceding and current row), 6)
      as aqi_smooth from f"""

DAILY = """with d as (
    select l_returnflag as city, cast(l_shipdate as date) as day, avg(l_quantity) as quantity,
      avg(cast(l_linenumber as double)) as line from lineitem group by 1, 2),
  s as (select city, day, 'quantity' as "column", quantity as mean from d
    union all select city, day, 'line', line from d)"""

STATS = f"""{OBS}, u as ({_unpivot('o', COLUMNS)}),
  m as (select "column", avg(value) as mu, count(*) as n from u group by 1),
  c as (select u."column", n, mu, value, value - mu as d from u join m using ("column")),
  p as (select "column", any_value(n) as "count", any_value(mu) as mean, stddev_samp(value) as std,
      min(value) as min, max(value) as max, avg(d * d) as m2, avg(d * d * d) as m3, avg(d * d * d * d) as m4,
      quantile_cont(value, 0.25) as p25, quantile_cont(value, 0.5) as p50, quantile_cont(value, 0.75) as p75,
      quantile_cont(value, 0.9) as p90, quantile_cont(value, 0.95) as p95
    from c group by 1)"""


def _fences(columns, keys=()) -> str:
    ks = "".join(f"{k}, " for k in keys)
    return f"""{OBS}, u as ({_unpivot('o', columns, ('event_id', 'city'))}),
      q as (select {ks}"column", quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
        from u group by {ks}"column"),
      b as (select *, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from q)"""


def _corr(a: str, b: str) -> str:
    return (f"round(covar_pop({b}::double, {a}::double) / "
            f"nullif(stddev_pop({a}::double) * stddev_pop({b}::double), 0), 6)")


PAIRS = list(combinations(COLUMNS, 2))
CORR_ROW = f"{OBS}, r as (select " + ", ".join(
    f"{_corr(a, b)} as r{i}" for i, (a, b) in enumerate(PAIRS)) + " from o)"
CORR = CORR_ROW + ", c as (" + " union all ".join(
    f"select '{a}' as var1, '{b}' as var2, r{i} as correlation from r"
    for i, (a, b) in enumerate(PAIRS)) + ")"
SPLIT = f"""(select event_id, row_number() over ({W}) - 1 as pos,
    floor(cast(count(*) over (partition by city) as double) * 0.8::double) as cut from obs)"""
NULL_COLUMNS = ["city", "timestamp", "event_id", "event_type", *V.MEASURES, "latitude", "longitude"]
MISSING = f"with {V.OBS_SQL}, m as (" + " union all ".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as missing_count, count(*) as n from obs_null"
    for c in NULL_COLUMNS) + ")"
OVERVIEW_ROWS = [("city", "string", "categorical"), ("timestamp", "timestamp", "datetime"),
                 *[(c, "double", "numeric") for c in (
                     "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone",
                     "dust", "uv_index", "temperature_2m", "relative_humidity_2m", "pressure_msl",
                     "wind_speed_10m", "wind_direction_10m", "precipitation", "cloud_cover",
                     "latitude", "longitude", "ozone_ppb", "nitrogen_dioxide_ppb", "sulphur_dioxide_ppb",
                     "carbon_monoxide_ppm")],
                 ("aqi", "int", "numeric")]

def _special() -> str:
    """Quantiles by rank: -Infinity, finite values, Infinity, NaN."""
    def value(share: float) -> str:
        at = f"({share!r}::double * (n - 1))"
        pick = lambda f: f"max(case when rn = {f}({at}) then v end)"
        low, high = pick("floor"), pick("ceil")
        weighted = f"(ceil(any_value({at})) - any_value({at})) * {low} + (any_value({at}) - floor(any_value({at}))) * {high}"
        return f"case when floor(any_value({at})) = ceil(any_value({at})) then {low} else {weighted} end"

    shown = ", ".join(f"case when not isnan({n}) then round(greatest(-1e300, least(1e300, {n})), 9) end as {n}" for n in SHARES)
    return f"""with {V.OBS_SQL}, s as (select city, case event_id % 9 when 0 then 'inf'::double when 3 then '-inf'::double
        when 6 then 'nan'::double else pm10 end as v from obs),
      r as (select *, row_number() over (partition by city order by v) - 1 as rn, count(*) over (partition by city) as n from s),
      q as (select city, {', '.join(f'{value(x)} as {n}' for n, x in SHARES.items())} from r group by city)
      select city, {shown} from q"""


ORACLES = {
    "quantiles_special": _special(),
    "sorted_positions": f"""with {V.OBS_SQL} select event_id, pm10,
        row_number() over (order by pm10 desc, event_id) - 1 as position from obs""",
    "chrono_split": f"""with {V.OBS_SQL} select event_id,
        case when pos < cut then 'train' else 'test' end as split from {SPLIT}""",
    "chrono_split_embargo": f"""with {V.OBS_SQL} select event_id,
        case when pos < cut then 'train' else 'test' end as split from {SPLIT}
        where pos < cut - 72 or pos >= cut""",
    "latest_change": f"""{OBS}, r as (select *, lag(aqi) over ({W}) as previous,
          row_number() over (partition by city order by timestamp desc, event_id desc) as rn,
          count(*) over (partition by city) as data_points from o)
        select city, timestamp as as_of, aqi as current, aqi - previous as change, data_points
        from r where rn = 1""",
    "hourly_resample_smooth": HOURLY,
    "seasonality": f"""{DAILY}, p as (select a.*, b.mean as earlier from s a
          left join s b on a.city = b.city and a."column" = b."column" and b.day = a.day - 7),
        r as (select city, "column", cast(max(day) - min(day) + 1 as int) as days,
          covar_pop(mean, earlier) / nullif(stddev_pop(mean) filter (earlier is not null)
            * stddev_pop(earlier), 0) as autocorr from p group by 1, 2)
        select city, "column", days, round(autocorr, 6) as autocorr,
          coalesce(days >= 30 and abs(autocorr) > 0.3, false) as seasonal from r""",
    "daily_trend": f"""{DAILY}, t as (select city, "column", avg(mean) as m, stddev_samp(mean) as sd,
          regr_slope(mean, cast(day - date '1970-01-01' as double)) as slope from s group by 1, 2)
        select city, "column", round(m, 6) as daily_mean, round(sd, 6) as daily_std,
          round(slope, 9) as trend_slope,
          case when slope > 0 then 'Increasing' else 'Decreasing' end as trend from t""",
    "last_week": f"""with {V.OBS_SQL} select event_id, timestamp from obs
        where timestamp >= (select max(timestamp) from obs) - interval 7 day""",
    "analysis_period": f"""with {V.OBS_SQL} select min(timestamp) as start, max(timestamp) as "end",
        cast(floor(epoch(max(timestamp) - min(timestamp)) / 86400) as int) as duration_days from obs""",
    "overview": f"with {V.OBS_SQL}, n as (select count(*) as row_count from obs) " + " union all ".join(
        f"select {i} as position, '{c}' as \"column\", '{t}' as dtype, '{r}' as role, row_count from n"
        for i, (c, t, r) in enumerate(OVERVIEW_ROWS)),
    "describe": f"""{STATS} select "column", "count", round(mean, 6) as mean, round(std, 6) as std,
        min, max, round(p25, 6) as p25, round(p50, 6) as p50, round(p75, 6) as p75 from p""",
    "distributions": f"""{STATS} select "column", round(mean, 6) as mean, round(std, 6) as std, min, max,
        round(m3 / nullif(pow(m2, 1.5), 0), 6) as skewness,
        round(m4 / nullif(m2 * m2, 0) - 3, 6) as kurtosis, round(p50, 6) as median,
        round(p25, 6) as p25, round(p75, 6) as p75, round(p90, 6) as p90, round(p95, 6) as p95 from p""",
    "outliers": f"""{_fences(COLUMNS)} select event_id, "column", value,
        round(lower, 6) as lower, round(upper, 6) as upper from u join b using ("column")
        where value < lower or value > upper""",
    "outlier_counts": f"""{_fences(COLUMNS, ['city'])} select city, "column",
        round(any_value(q1), 6) as q1, round(any_value(q3), 6) as q3,
        round(any_value(lower), 6) as lower, round(any_value(upper), 6) as upper,
        cast(sum(case when value < lower or value > upper then 1 else 0 end) as bigint) as outliers_count
        from u join b using (city, "column") group by 1, 2""",
    "corr_matrix": f"""{CORR} select * from c union all select var2, var1, correlation from c union all """
        + " union all ".join(f"select '{c}', '{c}', case when stddev_pop({c}) > 0 then 1.0 end from o"
                             for c in COLUMNS),
    "strong_corr": f"{CORR} select * from c where abs(correlation) > 0.7",
    "top_corr": f"""{CORR} select case when var1 = 'aqi' then var2 else var1 end as variable, correlation
        from c where var1 = 'aqi' or var2 = 'aqi' order by abs(correlation) desc nulls last, variable limit 10""",
    "missing_data": f"""{MISSING} select "column", missing_count,
        round(missing_count / n * 100, 6) as percentage from m where missing_count > 0""",
    "missing_total": f"""{MISSING} select cast(sum(missing_count) as bigint) as total_missing,
        round(sum(missing_count) / sum(n) * 100, 6) as missing_percentage from m""",
    "histogram": f"""with {V.OBS_SQL}, u as ({_unpivot('obs', V.MEASURES)}),
        r as (select *, min(value) over (partition by "column") as lo,
                max(value) over (partition by "column") as hi from u)
        select "column", least(cast(floor(30 * (value - lo) / (hi - lo)) as int) + 1, 30) as bin,
          round(any_value(lo + (least(floor(30 * (value - lo) / (hi - lo)) + 1, 30) - 1) * ((hi - lo) / 30)), 6) as bin_from,
          round(any_value(lo + least(floor(30 * (value - lo) / (hi - lo)) + 1, 30) * ((hi - lo) / 30)), 6) as bin_to,
          count(*) as n from r group by 1, 2""",
}
ORACLES |= {"profile_merged": ORACLES["distributions"], "corr_matrix_merged": ORACLES["corr_matrix"], "missing_merged": ORACLES["missing_data"]}
ORACLES |= {f"{f.__name__}_cut": ORACLES[f.__name__] for f in (*CUTS, hourly_resample_smooth)}
