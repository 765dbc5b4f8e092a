"""Checked queries: sources, upsert, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.checks import views as V
from skygrain.checks.features import OBS, W, quoted
from skygrain.functions import alert_text as A
from skygrain.operators import alerts as AL
from skygrain.operators import features as FE
from skygrain.operators import series as T
from skygrain.operators.ordered import ordered
from skygrain.sources import feature_table, payload

TEXT = ["severity", "source", "message", "threshold_exceeded"]


def _flat(df):
    return df.withColumn("recommendations", F.array_join("recommendations", "; "))


def payload_explode(spark, sf):
    """Payload objects of two hours each, built from events and read back as rows."""
    obs = V.obs(spark, sf)
    stamp = lambda t: F.date_format(t, payload.TIME_FORMAT)
    later = F.col("timestamp") + F.expr("interval 1 hour")
    hourly = F.struct(
        F.array(stamp(F.col("timestamp")), stamp(later)).alias("time"),
        *[F.array(F.col(c), F.col(c) + 1).alias(c) for c in S.POLLUTANTS])
    # an error event stands for a payload without hours
    broken = obs.select("city", F.when(F.col("event_type") != "error", hourly).alias("hourly"))
    return payload.payload_rows(broken, S.POLLUTANTS)


def join_inputs(spark, sf):
    return payload.join_inputs(
        V.air(spark, sf), V.weather(spark, sf), ["city", "timestamp", "event_id"]
    ).select("event_id", "city", "pm10", "ozone", "temperature_2m", "cloud_cover")


def upsert_latest(spark, sf):
    obs = V.obs(spark, sf).select("city", "timestamp", "event_id", "event_type", "pm10")
    first = obs.withColumn("ingest_ts", F.lit(1))
    second = obs.filter("event_type = 'purchase'").withColumns({
        "pm10": F.col("pm10") + 1, "ingest_ts": F.lit(2)})
    return feature_table.latest_versions(
        first.unionByName(second), ["city", "timestamp"], ties=["event_id"])


def newest_n(spark, sf):
    return T.newest(V.obs(spark, sf), 1000, (), V.ORDER).select("event_id", "city", "pm10")


def newest_n_per_city(spark, sf):
    return T.newest(V.obs(spark, sf), 100, ["city"], V.ORDER).select("event_id", "city", "pm10")


def alert_severity(spark, sf):
    return _flat(AL.build_alerts(V.obs_aqi(spark, sf).select(
        "event_id", "timestamp", F.lit("current").alias("source"), "aqi")))


def _predictions(df):
    """Two plain forecasts per reading: the last value and the mean of twelve."""
    o = ordered(df, ["city"], V.ORDER, back=11)
    rolled = o.finish(FE.with_rolling(o.frame, ["aqi"], o.window, [12], ("mean",)))
    wide = rolled.select(
        "city", F.col("timestamp").alias("as_of"), "event_id",
        F.col("aqi").cast("double").alias("persistence"),
        F.col(S.rolling_name("aqi", "mean", 12)).alias("mean_12"))
    return wide.unpivot(["city", "as_of", "event_id"], ["persistence", "mean_12"], "model", "prediction").withColumn(
        "horizon", F.when(F.col("model") == "persistence", 1).otherwise(6))


def alert_candidates(spark, sf):
    df = V.obs_aqi(spark, sf)
    current = df.select("city", F.col("timestamp").alias("as_of"), "event_id", F.col("aqi").alias("current"))
    found = AL.build_alerts(AL.candidates(current, _predictions(df), ["city", "event_id"]))
    return found.select("event_id", "timestamp", "aqi_value", *TEXT)


def _history(spark, sf):
    """Every event as a stored alert, its type being the source."""
    events = V.table(spark, sf, "events").select(
        F.col("event_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("source"), F.col("value").alias("aqi"))
    return AL.build_alerts(events)


def _end(spark, sf):
    return V.table(spark, sf, "events").agg(F.max("ts").cast("timestamp")).first()[0]


def alert_dedup(spark, sf):
    """All values as candidates against the alerts of the last 24 hours."""
    history = _history(spark, sf)
    return AL.new_alerts(history, history, _end(spark, sf), keys=(), hours=24).select(
        "event_id", "aqi_value", "severity", "source")


def alert_recent(spark, sf):
    return AL.recent_alerts(_history(spark, sf), _end(spark, sf), 24, 10, ("timestamp", "event_id")).select(
        "event_id", "timestamp", "aqi_value", *TEXT)


def alert_summary(spark, sf):
    s = AL.alert_summary(_history(spark, sf), _end(spark, sf), 24, (), ("timestamp", "event_id"))
    return s.select(
        "total_alerts", *[f"{x[0]}_count" for x in A.SEVERITIES],
        F.col("latest_alert.timestamp").alias("latest_at"),
        F.col("latest_alert.message").alias("latest_message"),
        F.col("highest_aqi.aqi_value").alias("highest_value"),
        F.col("highest_aqi.message").alias("highest_message"))


def alert_summary_by_source(spark, sf):
    s = AL.alert_summary(_history(spark, sf), _end(spark, sf), 240, ["source"], ("timestamp", "event_id"))
    return s.select("source", "total_alerts", *[f"{x[0]}_count" for x in A.SEVERITIES],
                    F.col("highest_aqi.message").alias("highest_message"))


def alert_retention(spark, sf):
    return AL.retained(_history(spark, sf), 1000, (), ("timestamp", "event_id")).select(
        "event_id", "timestamp", "aqi_value", "severity")


def critical_alerts(spark, sf):
    return AL.critical_alerts(_history(spark, sf)).select("event_id", "aqi_value", "message")


def alert_thresholds(spark, sf):
    """Alerts per severity with the threshold table's range and wording."""
    return (_history(spark, sf).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
            .join(F.broadcast(A.thresholds(spark)), "severity"))  # four rows


SPLIT_KEY = ["city", "timestamp", "event_id"]


def random_split(spark, sf):
    """Four fifths of all rows by a hash of their key, exactly."""
    return feature_table.random_split(V.obs(spark, sf), SPLIT_KEY).select("event_id", "split")


def sample_rows(spark, sf):
    return feature_table.sample_rows(V.obs(spark, sf), 100, SPLIT_KEY).select("event_id", "city")


QUERIES = {f.__name__: f for f in (
    payload_explode, join_inputs, upsert_latest, newest_n, newest_n_per_city, alert_severity,
    alert_candidates, alert_dedup, alert_recent, alert_summary, alert_summary_by_source,
    alert_retention, critical_alerts, alert_thresholds, random_split, sample_rows)}


# --- SQL twins -------------------------------------------------------------------

def _severity(value: str, pick) -> str:
    whens = " ".join(f"when {value} >= {s[1]} then {pick(s)}" for s in A.SEVERITIES[:-1])
    return f"case {whens} else {pick(A.SEVERITIES[-1])} end"


def alert_sql(source: str, name: str) -> str:
    """CTE ``name``: the alerts of a relation with columns ``aqi`` and ``source``."""
    one = "round_even(cast(aqi as double), 1)"
    return f"""{name} as (select *, {one} as aqi_value,
        {_severity('aqi', lambda s: quoted(s[0]))} as severity,
        {_severity('aqi', lambda s: quoted(s[2]))} as threshold_exceeded,
        concat({_severity('aqi', lambda s: quoted(s[3]))}, ' detected: AQI ', cast({one} as varchar),
               ' (', source, ')') as message,
        {_severity('aqi', lambda s: quoted('; '.join(A.RECOMMENDATIONS[s[0]])))} as recommendations
        from {source} where aqi > 50)"""


HISTORY = f"""with ev as (select event_id, cast(ts as timestamp) as timestamp, event_type as source,
    value as aqi from events), {alert_sql('ev', 'a')},
  t as (select max(timestamp) as as_of from ev)"""
COUNTS = ", ".join(f"count(*) filter (severity = '{s[0]}') as {s[0]}_count" for s in A.SEVERITIES)

_HASHED = "md5(concat_ws('|', city, cast(epoch_us(timestamp) as varchar), cast(event_id as varchar), '42'))"

ORACLES = {
    "random_split": f"""with {V.OBS_SQL} select event_id, case when row_number() over (order by {_HASHED})
        <= floor(count(*) over () * 0.8::double) then 'train' else 'test' end as split from obs""",
    "sample_rows": f"with {V.OBS_SQL} select event_id, city from obs order by {_HASHED} limit 100",
    "payload_explode": f"""with {V.OBS_SQL}, p as (select * from obs where event_type <> 'error')
        select city, date_trunc('minute', timestamp) as timestamp, {', '.join(S.POLLUTANTS)} from p
        union all select city, date_trunc('minute', timestamp) + interval 1 hour,
        {', '.join(f'{c} + 1' for c in S.POLLUTANTS)} from p""",
    "join_inputs": f"""with {V.OBS_SQL} select a.event_id, a.city, a.pm10, a.ozone, w.temperature_2m, w.cloud_cover
        from obs a join (select * from obs where event_type <> 'error') w
        on a.city = w.city and a.timestamp = w.timestamp and a.event_id = w.event_id""",
    "upsert_latest": f"""with {V.OBS_SQL}, u as (
          select city, timestamp, event_id, event_type, pm10, 1 as ingest_ts from obs union all
          select city, timestamp, event_id, event_type, pm10 + 1, 2 from obs where event_type = 'purchase')
        select * exclude (rn) from (select *, row_number() over (
          partition by city, timestamp order by ingest_ts desc, event_id desc) as rn from u) where rn = 1""",
    "newest_n": f"""with {V.OBS_SQL} select event_id, city, pm10 from obs
        order by timestamp desc, event_id desc limit 1000""",
    "newest_n_per_city": f"""with {V.OBS_SQL} select event_id, city, pm10 from (select *, row_number() over (
        partition by city order by timestamp desc, event_id desc) as rn from obs) where rn <= 100""",
    "alert_severity": f"""{OBS}, c as (select event_id, timestamp, 'current' as source, aqi from o),
        {alert_sql('c', 'a')} select event_id, timestamp, source, aqi_value, severity, message,
        threshold_exceeded, recommendations from a""",
    "alert_candidates": f"""{OBS}, m as (select *, avg(aqi) over ({W} rows between 11 preceding and current row)
          as mean_12 from o),
        c as (select event_id, timestamp, 'current' as source, cast(aqi as double) as aqi from m union all
          select event_id, timestamp, '1h_persistence', cast(aqi as double) from m union all
          select event_id, timestamp, '6h_mean_12', mean_12 from m), {alert_sql('c', 'a')}
        select event_id, timestamp, source, aqi_value, severity, message, threshold_exceeded from a""",
    "alert_dedup": f"""{HISTORY} select event_id, aqi_value, severity, source from a
        where not exists (select 1 from a h, t where h.source = a.source and h.severity = a.severity
          and h.timestamp > t.as_of - interval 24 hour and abs(h.aqi_value - a.aqi_value) < 5)""",
    "alert_recent": f"""{HISTORY} select event_id, timestamp, aqi_value, severity, source, message,
        threshold_exceeded from a, t where timestamp > as_of - interval 24 hour
        order by timestamp desc, event_id desc limit 10""",
    "alert_summary": f"""{HISTORY} select count(*) as total_alerts, {COUNTS},
        max(timestamp) as latest_at, arg_max(message, (timestamp, event_id)) as latest_message,
        max(aqi_value) as highest_value,
        arg_max(message, (aqi_value, timestamp, event_id)) as highest_message
        from a, t where timestamp > as_of - interval 24 hour""",
    "alert_summary_by_source": f"""{HISTORY} select source, count(*) as total_alerts, {COUNTS},
        arg_max(message, (aqi_value, timestamp, event_id)) as highest_message
        from a, t where timestamp > as_of - interval 240 hour group by source""",
    "alert_retention": f"""{HISTORY} select event_id, timestamp, aqi_value, severity from a
        order by timestamp desc, event_id desc limit 1000""",
    "critical_alerts": f"{HISTORY} select event_id, aqi_value, message from a where severity = 'critical'",
    "alert_thresholds": f"""{HISTORY}, d (severity, label, aqi_range, description) as (values """ + ", ".join(
        f"({quoted(n.lower())}, {quoted(n)}, {quoted(r)}, {quoted(x)})" for n, r, x in A.THRESHOLD_ROWS)
        + """) select severity, n, label, aqi_range, description
        from (select severity, count(*) as n from a group by 1) join d using (severity)""",
}
