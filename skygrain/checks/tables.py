"""Checked queries: versioned tables, bounded updates, the state of each city."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.checks import views as V
from skygrain.checks.alerting import alert_sql
from skygrain.checks.features import OBS, W, _category, aqi_sql
from skygrain.functions.index import with_aqi
from skygrain.operators import alerts as AL
from skygrain.operators.ordered import ordered
from skygrain.operators.touched import POSITION, touched_ranges
from skygrain.plans import ingest, state
from skygrain.plans.counts import Counts
from skygrain.session import scratch_root
from skygrain.sources import payload, versioned

ROW_KEY = ["city", "timestamp", "event_id"]
AS_OF = "2024-02-01 00:00:00"
# Fixed linear forecasts from the newest complete row: horizon, weight of pm2_5, weight of ozone.
MODELS = [(1, 0.5, 0.25), (6, 0.25, 0.5), (24, 1.5, 0.125)]


def _batches(spark, sf):
    """Three overlapping batches of readings: most rows, then new ones and corrections, then corrections of corrections."""
    obs = V.obs(spark, sf).select(*ROW_KEY, "event_type", "pm10")
    return [obs.filter("event_id % 3 <> 0"),
            obs.filter("event_id % 2 = 0").withColumn("pm10", F.col("pm10") + 1),
            obs.filter("event_type = 'click' or event_id % 5 = 0").withColumns({"pm10": F.col("pm10") * 2, "note": F.lit("again")})]


def _path(spark, name):
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def upsert_table(spark, sf):
    """Overlapping batches written to a versioned table and read back; the last one brings a new column."""
    path = _path(spark, "upsert")
    for batch in _batches(spark, sf):
        versioned.append(spark, path, batch, ROW_KEY, "timestamp", buckets=3)
    return versioned.read(spark, path, ROW_KEY)


def compacted_table(spark, sf):
    """The same with a compaction and a deletion of what it replaced before the last batch."""
    path = _path(spark, "compacted")
    first, second, third = _batches(spark, sf)
    versioned.append(spark, path, first, ROW_KEY, "timestamp", buckets=3)
    versioned.append(spark, path, second, ROW_KEY, "timestamp")
    versioned.compact(spark, path, ROW_KEY, share=0.1)
    versioned.vacuum(spark, path)
    versioned.append(spark, path, third, ROW_KEY, "timestamp")
    return versioned.read(spark, path, ROW_KEY)


def stale_buckets(spark, sf):
    """Stored and current rows of every month that holds replaced ones."""
    path = _path(spark, "stale")
    for batch in _batches(spark, sf):
        versioned.append(spark, path, batch, ROW_KEY, "timestamp", buckets=1)
    return versioned.stale(spark, path, ROW_KEY).select("event_month", "n", "current")


def update_touched_ranges(spark, sf):
    """Rows that an update computes again if all error events are new or corrected."""
    o = ordered(V.obs(spark, sf), ["city"], V.ORDER)
    changed = o.finish(o.frame.select("*", o.position.alias(POSITION))).filter("event_type = 'error'")
    return touched_ranges(changed, ["city"], ingest.TARGET_REACH, ingest.FEATURE_REACH)


def _rows(spark, sf):
    """Feature rows of which some lack a sensor; in city C1 the ozone sensor is dead since 20 January."""
    dead = (F.col("city") == "C1") & (F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp"))
    df = V.obs_null(spark, sf).withColumn("ozone", F.when(~dead, F.col("ozone")))
    rows = with_aqi(df).select(*ROW_KEY, "aqi", "pm2_5", "ozone")
    return rows.withColumn(state.COMPLETE, F.col("pm2_5").isNotNull() & F.col("ozone").isNotNull())


def _places(df):
    out = df.select("city", *[F.col(f"{p}.event_id").alias(p) for p in ("at", "before", "inputs_at")], "aqi", "previous",
                    F.col(f"{state.INPUTS}.pm2_5").alias("pm2_5"), F.col(f"{state.INPUTS}.ozone").alias("ozone"))
    return out


def city_state(spark, sf):
    """The state of each city, one pass over all rows."""
    return _places(state.summarise(_rows(spark, sf), order=V.ORDER))


def city_state_merged(spark, sf):
    """The state after late rows, and corrections that take a sensor away from the newest complete rows."""
    rows = _rows(spark, sf)
    newest = rows.filter(state.COMPLETE).groupBy("city").agg(F.max(F.struct(*V.ORDER)).alias("n"))
    spoilt = rows.join(newest, "city").filter(F.struct(*V.ORDER) == F.col("n")).select(*rows.columns).withColumns(
        {"ozone": F.lit(None).cast("double"), state.COMPLETE: F.lit(False)})
    old = state.summarise(rows.filter("event_id % 5 <> 0 or is_complete"), order=V.ORDER)
    late = rows.filter("event_id % 5 = 0 and not is_complete").union(spoilt)
    merged, gone = state.merge_states(old, late, order=V.ORDER)
    history = rows.join(spoilt.select(*ROW_KEY), ROW_KEY, "left_anti").union(spoilt).join(gone, "city", "left_semi")
    return _places(state.looked_up(merged, history, order=V.ORDER))


def _predictions(current):
    rows = state.model_inputs(current)
    entries = [F.struct(F.lit(h).alias("horizon"), F.lit("linear").alias("model"), (F.col("pm2_5") * a + F.col("ozone") * b).alias("prediction")) for h, a, b in MODELS]
    return rows.select("city", F.explode(F.array(*entries)).alias("e")).select("city", "e.*"), [(h, "linear") for h, _, _ in MODELS]


def alert_check(spark, sf):
    """Alerts of current values and forecasts; where the newest row lacks a sensor the current value stands for the forecast."""
    current = state.summarise(_rows(spark, sf), order=V.ORDER)
    predictions, models = _predictions(current)
    checked = state.check_values(current, predictions, models, F.lit(AS_OF).cast("timestamp"))
    return AL.build_alerts(checked).select("city", "timestamp", "source", "aqi_value", "severity", "message")


def snapshot(spark, sf):
    rows = _rows(spark, sf)
    current = state.summarise(rows, order=V.ORDER)
    predictions, models = _predictions(current)
    counts = rows.groupBy("city").agg(F.count(F.lit(1)).alias("data_points"))
    return state.snapshot_rows(current, predictions, models, counts)


def _landed(spark, sf, variables):
    """Landed payload files, one object each: a file per city and day, with an empty and a broken one beside them."""
    path = f"{scratch_root(spark)}/landed-{uuid.uuid4().hex}"
    rows = V.obs(spark, sf).withColumn("day", F.to_date("timestamp"))
    entry = F.struct("timestamp", "event_id", *variables)
    days = rows.groupBy("city", "day").agg(F.sort_array(F.collect_list(entry)).alias("h"))
    stamps = F.transform("h", lambda x: F.date_format(x["timestamp"], payload.TIME_FORMAT))
    hourly = F.struct(stamps.alias("time"), *[F.col(f"h.{v}").alias(v) for v in variables])
    files = days.select(F.to_json(F.struct("city", hourly.alias("hourly"))).alias("value"), F.col("city").alias("c"), F.col("day").cast("string").alias("d"))
    files.repartition("c", "d").write.partitionBy("c", "d").text(path)
    odd = spark.createDataFrame([('{"city": "C1", "hourly": {"time": []}}', "empty"), ("{not json", "broken")], "value string, d string").withColumn("c", F.lit("x"))
    odd.repartition("c", "d").write.mode("append").partitionBy("c", "d").text(path)
    return path


def payload_files(spark, sf):
    """Pollutant files landed as JSON and read back, each city and minute once."""
    return payload.read_air(spark, _landed(spark, sf, S.POLLUTANTS))


def weather_files(spark, sf):
    return payload.read_weather(spark, _landed(spark, sf, S.WEATHER))


def run_counts(spark, sf):
    """Rows and columns of the steps of a run, counted by the writes they have anyway."""
    counts = Counts("check", datetime(2024, 2, 1))
    batch = counts.durable(V.obs(spark, sf), "observations")
    rows = counts.durable(_rows(spark, sf), "features")
    counts.durable(rows.filter(state.COMPLETE), "complete")
    counts.durable(batch.filter("event_type = 'error'").select("city", "event_id"), "errors")
    counts.durable(batch.filter("event_id < 0"), "nothing")
    counts.note("models", len(MODELS))
    return counts.table(spark)


QUERIES = {f.__name__: f for f in (
    payload_files, weather_files, run_counts, upsert_table, compacted_table, stale_buckets, update_touched_ranges, city_state, city_state_merged, alert_check, snapshot)}


# --- SQL twins -------------------------------------------------------------------

_MERGED = f"""with {V.OBS_SQL}, u as (
      select 1 as v, city, timestamp, event_id, event_type, pm10, null as note from obs where event_id % 3 <> 0 union all
      select 2, city, timestamp, event_id, event_type, pm10 + 1, null from obs where event_id % 2 = 0 union all
      select 3, city, timestamp, event_id, event_type, pm10 * 2, 'again' from obs where event_type = 'click' or event_id % 5 = 0),
    m as (select * exclude (v) from u qualify row_number() over (partition by city, timestamp, event_id order by v desc) = 1)"""
_MERGED_ROWS = f"{_MERGED} select *, strftime(timestamp, '%Y-%m') as event_month from m"

_ROWS = f"""with {V.OBS_SQL}, d as (select * replace (case when not (city = 'C1' and timestamp >= timestamp '2024-01-20') then ozone end as ozone) from obs_null),
    {aqi_sql('o', 'd')}, r as (select city, timestamp, event_id, aqi, pm2_5, ozone, pm2_5 is not null and ozone is not null as ok from o)"""
_ORDERED = "(timestamp, event_id)"


def _state(rows: str) -> str:
    """CTE ``s``: the state of each city."""
    return f"""k as (select *, row_number() over (partition by city order by timestamp desc, event_id desc) as rn from {rows} where aqi is not null),
      c as (select * from {rows} where ok qualify row_number() over (partition by city order by timestamp desc, event_id desc) = 1),
      s as (select k.city, k.event_id as "at", k.timestamp as at_time, k.aqi, p.event_id as before, p.aqi as previous, c.event_id as inputs_at, c.pm2_5, c.ozone
        from k left join k p on p.city = k.city and p.rn = 2 left join c on c.city = k.city where k.rn = 1)"""


_SPOILT = """b as (select * from r where ok qualify row_number() over (partition by city order by timestamp desc, event_id desc) = 1),
    x as (select r.* replace (case when b.event_id is null then r.ozone end as ozone, r.ok and b.event_id is null as ok)
      from r left join b on b.city = r.city and b.event_id = r.event_id)"""
_FORECASTS = "f (horizon, wa, wb) as (values " + ", ".join(f"({h}, {a}::double, {b}::double)" for h, a, b in MODELS) + ")"
_PREDICTED = 'case when s.inputs_at = s."at" then s.pm2_5 * f.wa + s.ozone * f.wb end'

_STEPS = [("observations", "(select count(*) from obs)", 21), ("features", "(select count(*) from r)", 7), ("complete", "(select count(*) from r where ok)", 7),
          ("errors", "(select count(*) from obs where event_type = 'error')", 2), ("nothing", "0", 21), ("models", str(len(MODELS)), 1)]

def _files_sql(variables) -> str:
    return f"""with {V.OBS_SQL} select city, date_trunc('minute', timestamp) as timestamp, {', '.join(variables)} from obs
        qualify row_number() over (partition by city, date_trunc('minute', timestamp) order by timestamp desc, event_id desc) = 1"""


ORACLES = {
    "payload_files": _files_sql(S.POLLUTANTS),
    "weather_files": _files_sql(S.WEATHER),
    "run_counts": f"{_ROWS} " + " union all ".join(
        f"select 'r20240201T000000000000' as run_id, 'check' as job, '{step}' as step, cast({i} as int) as position, cast({n} as bigint) as rows, cast({c} as int) as columns"
        for i, (step, n, c) in enumerate(_STEPS)),
    "upsert_table": _MERGED_ROWS,
    "compacted_table": _MERGED_ROWS,
    "stale_buckets": f"""{_MERGED} select strftime(timestamp, '%Y-%m') as event_month, cast(count(*) as bigint) as n,
        cast(count(distinct (city, timestamp, event_id)) as bigint) as current from u group by 1""",
    "update_touched_ranges": f"""with {V.OBS_SQL}, p as (select *, row_number() over ({W}) - 1 as pos from obs),
        c as (select city, greatest(pos - {ingest.TARGET_REACH}, 0) as low, pos + {ingest.FEATURE_REACH} as high from p where event_type = 'error'),
        b as (select *, max(high) over (partition by city order by low rows between unbounded preceding and 1 preceding) as reached from c),
        g as (select *, sum(case when low <= reached + 1 then 0 else 1 end) over (partition by city order by low rows unbounded preceding) as run from b)
        select city, cast(min(low) as bigint) as low, cast(max(high) as bigint) as high from g group by city, run""",
    "city_state": f'{_ROWS}, {_state("r")} select city, "at", before, inputs_at, aqi, previous, pm2_5, ozone from s',
    "city_state_merged": f'{_ROWS}, {_SPOILT}, {_state("x")} select city, "at", before, inputs_at, aqi, previous, pm2_5, ozone from s',
    "alert_check": f"""{_ROWS}, {_state('r')}, {_FORECASTS},
        w as (select city, timestamp '{AS_OF}' as timestamp, 'current' as source, cast(aqi as double) as aqi from s union all
          select city, timestamp '{AS_OF}', concat(horizon, 'h_linear'), coalesce({_PREDICTED}, aqi) from s, f), {alert_sql('w', 'a')}
        select city, timestamp, source, aqi_value, severity, message from a""",
    "snapshot": f"""{_ROWS}, {_state('r')}, {_FORECASTS}, n as (select city, count(*) as data_points from r group by 1),
        j as (select s.*, horizon, {_PREDICTED} as prediction from s, f)
        select city, at_time as as_of, aqi as current, aqi - previous as change, {_category(1)} as category, data_points, cast(horizon as int) as horizon,
          'linear' as model, prediction, case when prediction is null then 'missing' else 'ok' end as status from j join n using (city)""",
}
