"""Landed files through the jobs; incremental results equal a full build."""

import json
import math
import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.plans import ingest, jobs, model_report, report, serving
from skygrain.plans.counts import read_counts
from skygrain.plans.store import Store, day_range
from skygrain.sources import feature_table, payload, registry

START = datetime(2025, 1, 20)
CITIES = {"Rome": 0, "Oslo": 5}


def _value(name, i):
    return round(40 + 30 * math.sin(i / 9 + len(name)) + (i * 7919 + len(name) * 31) % 23, 2)


def _payload(city, variables, first, hours, offset=0.0):
    times = [(START + timedelta(hours=first + i)).strftime("%Y-%m-%dT%H:%M") for i in range(hours)]
    return {"city": city, "latitude": 1.0, "hourly": {"time": times, **{
        v: [_value(v, first + i + CITIES[city]) + offset for i in range(hours)] for v in variables}}}


def _land(folder, name, obj):
    with open(f"{folder}/{name}.json", "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, indent=1))


@pytest.fixture(scope="module")
def landed():
    air, weather = tempfile.mkdtemp(prefix="air-"), tempfile.mkdtemp(prefix="weather-")
    for city in CITIES:
        _land(air, city, _payload(city, S.POLLUTANTS, 0, 500))
        _land(weather, city, _payload(city, S.WEATHER, 0, 496))
    _land(air, "empty", {"city": "Rome", "hourly": {"time": []}})
    _land(air, "missing", {"city": "Rome", "reason": "limit"})
    _land(air, "broken", "{not json")
    bad = _payload("Rome", S.POLLUTANTS, 900, 3)
    bad["hourly"]["ozone"] = [1.0]
    _land(air, "uneven", bad)
    return air, weather


@pytest.fixture(scope="module")
def locations(spark):
    return spark.createDataFrame(
        [("Rome", 41.9, 12.5), ("Oslo", 59.9, 10.7)], "city string, latitude double, longitude double")


@pytest.fixture(scope="module")
def observations(spark, landed, locations):
    return payload.observations(spark, *landed, locations).cache()


def test_payloads(spark, landed, observations):
    assert observations.schema.names == S.OBSERVATIONS.names
    assert observations.count() == 2 * 496
    row = observations.filter("city = 'Rome'").orderBy("timestamp").first()
    assert row.timestamp == START and row.ozone == _value("ozone", 0) and row.latitude == 41.9
    assert payload.read_air(spark, landed[0], "2099-01-01T00:00:00").isEmpty()
    files = payload.rejected(payload.read_payloads(spark, landed[0], S.POLLUTANTS), S.POLLUTANTS)
    names = {r.file.rsplit("/", 1)[1] for r in files.collect()}
    assert names == {"empty.json", "missing.json", "broken.json", "uneven.json"}


def test_a_correction_beside_the_file_it_corrects_wins(spark, tmp_path):
    """Smaller values in a newer file count; hours of two files do not multiply in the join."""
    air, weather = tmp_path / "air", tmp_path / "weather"
    for folder, variables in ((air, S.POLLUTANTS), (weather, S.WEATHER)):
        folder.mkdir()
        for name, first, offset, at in (("b_old", 0, 0.0, 1_000_000_000), ("a_new", 5, -10.0, 1_000_000_100)):
            _land(folder, name, _payload("Rome", variables, first, 20, offset))
            os.utime(folder / f"{name}.json", (at, at))
    cities = spark.createDataFrame([("Rome", 1.0, 2.0)], "city string, latitude double, longitude double")
    rows = {r.timestamp: r for r in payload.observations(spark, str(air), str(weather), cities).collect()}
    assert len(rows) == 25
    for hour, r in ((int((t - START).total_seconds() // 3600), r) for t, r in rows.items()):
        assert r.pm10 == _value("pm10", hour) - (10.0 if hour >= 5 else 0.0) and r.cloud_cover == _value("cloud_cover", hour) - (10.0 if hour >= 5 else 0.0)


def _features(spark, store):
    df = feature_table.read_table(spark, store.features).drop("ingest_ts")
    rows = {}
    for r in df.collect():
        rows[(r.city, r.timestamp)] = r.asDict()
    return rows


def test_update_equals_full_build(spark, observations):
    """Batches in order, a late one and a correction give the table of one build."""
    folder = tempfile.mkdtemp(prefix="store-")
    whole, steps = Store(folder + "/whole"), Store(folder + "/steps")
    moment = datetime(2025, 3, 1)
    fixed = observations.withColumns({
        "pm10": F.when((F.col("city") == "Rome") & (F.hour("timestamp") == 5), F.col("pm10") + 100)
        .otherwise(F.col("pm10")),
        "ozone": F.when((F.col("city") == "Oslo") & (F.dayofmonth("timestamp") == 3), None)
        .otherwise(F.col("ozone"))})
    ingest.write_observations(spark, whole, fixed, moment)
    ingest.build_features(spark, whole, moment)

    t = F.col("timestamp")
    late = (t >= "2025-01-30") & (t < "2025-01-31") & (F.col("city") == "Rome")
    batches = [
        observations.filter((t < "2025-02-05") & ~late),
        observations.filter((t >= "2025-02-05") & (t < "2025-02-06")),
        fixed.filter(late),
        observations.filter(t >= "2025-02-06"),
        fixed.filter(((F.col("city") == "Rome") & (F.hour("timestamp") == 5))
                     | ((F.col("city") == "Oslo") & (F.dayofmonth("timestamp") == 3))),
    ]
    for i, batch in enumerate(batches):
        now = moment + timedelta(hours=i)
        ingest.write_observations(spark, steps, batch, now)
        ingest.update_features(spark, steps, batch, now)
    a, b = _features(spark, whole), _features(spark, steps)
    assert set(a) == set(b) and len(a) == 2 * 496
    for key, row in a.items():
        for c, v in row.items():
            w = b[key][c]
            if isinstance(v, float) and w is not None:
                assert w == pytest.approx(v, rel=1e-9, abs=1e-9), (key, c)
            else:
                assert w == v, (key, c)
    assert not a[("Oslo", datetime(2025, 2, 3, 4))]["is_complete"]
    assert len(a[("Rome", START)]) == 118 + 2  # all features, month and completeness


def test_upsert_is_idempotent(spark, observations):
    store = Store(tempfile.mkdtemp(prefix="store-"))
    for _ in range(2):
        ingest.write_observations(spark, store, observations, datetime(2025, 3, 1))
    assert ingest.read_observations(spark, store).count() == 2 * 496
    newest = feature_table.read_newest(spark, store.observations, 3, ["city"])
    assert newest.groupBy("city").count().filter("count = 3").count() == 2


def test_setup_update_and_the_rest(spark, landed, locations):
    air, weather = landed
    store = Store(tempfile.mkdtemp(prefix="store-"))
    first = datetime(2025, 2, 9, 12)
    assert jobs.setup(spark, store, air, weather, locations, first, "2025-01-20", "2025-02-08")
    assert report.latest_report(spark, store, "period").first().duration_days == 19

    metrics = registry.read_metrics(spark, store.metrics)
    assert metrics.count() == 12 and metrics.filter("metrics.mae is null").count() == 0
    models = registry.load_models(spark, store.models)
    assert [(f.algorithm, f.horizon) for f, _ in models] == [
        (a, h) for a in ("random_forest", "ridge_regression") for h in S.HORIZONS]
    assert len(models[0][0].features) == 107

    alerts = serving.read_alerts(spark, store)
    stored = alerts.count()
    assert stored > 0 and alerts.filter("aqi_value <= 50").count() == 0
    fresh, _ = jobs.alerts(spark, store, first + timedelta(minutes=59))
    assert fresh.count() == 0  # all are repeats within the hour
    fresh, summary = jobs.alerts(spark, store, first + timedelta(minutes=60))
    assert fresh.count() == stored
    assert {r.city for r in summary.collect()} <= set(CITIES)

    snap = serving.snapshot(spark, store, first)
    assert snap.count() == 2 * 12 and snap.filter("status != 'ok'").count() == 0
    top = registry.read_section(spark, store.attributions, "top_features")
    assert top.groupBy("model", "horizon").count().filter("count = 10").count() == 12
    by_horizon = top.filter("model = 'random_forest' and rank = 1").select("horizon", "importance").distinct()
    assert by_horizon.count() == 6  # each horizon by its own forest

    summary = registry.read_section(spark, store.attributions, "summary")
    assert summary.count() == 12 and {r.total_features for r in summary.collect()} <= {107, 106, 105, 104, 103, 102}
    why = model_report.explain_latest(spark, store).collect()
    assert len(why) == 2 * 12 and all(abs(r.prediction) < 1e4 and len(r.feature_values) == len(r.feature_contributions) for r in why)

    assert jobs.update(spark, store, air, weather, locations, datetime(2025, 2, 9, 18))
    best = model_report.read_metric_report(spark, store, "best_model").first()
    assert best.total_models == 12 and best.best_mae is not None  # the newest run only
    assert model_report.read_metric_report(spark, store, "horizons").count() == 6
    steps = read_counts(spark, store).filter("job = 'update'").orderBy("position").collect()
    assert [r.step for r in steps] == ["batch", "observations", "features", "metrics", "models", "alerts"]
    assert steps[0].rows == steps[1].rows and steps[2].rows >= steps[1].rows and steps[4].rows == 12
    rows = ingest.read_features(spark, store).count()
    assert set(jobs.retention(spark, store, 5)) == {"observations", "features", "row_index", "state"}
    assert ingest.read_features(spark, store).count() == rows and serving.read_alerts(spark, store).groupBy("city").count().filter("count > 5").count() == 0
    single = jobs.single_horizon(spark, store).collect()
    assert {r.algorithm for r in single} == {"random_forest", "ridge_regression"} and all(r.test_n > 0 for r in single)
    assert registry.read_metrics(spark, store.metrics).filter("update_type = 'daily'").count() == 12
    assert registry.newest_versions(registry.registered(spark, store.models)).select(
        "version").distinct().count() == 1
    assert ingest.read_observations(spark, store).agg(F.max("timestamp")).first()[0] == START + timedelta(hours=495)
    assert jobs.update(spark, store, air, weather, locations, datetime(2026, 1, 1))  # nothing landed


def test_metric_files(spark):
    folder = tempfile.mkdtemp(prefix="metrics-")
    record = {"model_name": "x", "horizon": 6, "algorithm": "rf", "metrics": {"mse": 1, "mae": 2.5, "r2": 0.5},
              "training_timestamp": "2025-01-01T00:00:00", "version": "1.0"}
    _land(folder, "multi_rf_h6_metrics", record)
    _land(folder, "broken_metrics", "{oops")
    _land(folder, "other", record)
    rows = registry.read_metric_files(spark, folder).collect()
    assert [(r.model_name, r.metrics.mae) for r in rows] == [("multi_rf_h6", 2.5)]


def test_day_range():
    now = datetime(2025, 5, 2, 3)
    assert day_range(None, None, now, 1) == ("2025-05-01", "2025-05-02")
    assert day_range("2025-01-01", "2025-01-02", now, 1) == ("2025-01-01", "2025-01-02")
    assert day_range("2025-01-01", None, now, 1) == ("2025-01-01", "2025-05-02")
    assert day_range(None, "2025-03-01", now, 5) == ("2025-02-24", "2025-03-01")
    with pytest.raises(ValueError):
        day_range("2025-13-01", "2025-01-02", now, 1)


def test_alert_history_is_complete_until_it_is_trimmed(spark, tmp_path):
    store, now = Store(str(tmp_path)), datetime(2025, 5, 2, 12)
    rows = spark.range(1500).select(
        F.lit("a").alias("city"), (F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("double"))).alias("timestamp"),
        F.lit(60.0).alias("aqi_value"), F.lit("low").alias("severity"), F.col("id").cast("string").alias("source"), F.lit("m").alias("message"),
        F.lit("t").alias("threshold_exceeded"), F.array().cast("array<string>").alias("recommendations"))
    rows.withColumn("alert_day", F.to_date("timestamp")).write.partitionBy("alert_day").parquet(store.alerts)
    assert serving.read_alerts(spark, store).count() == 1500
    serving.trim_alerts(spark, store, 1000)
    kept = serving.read_alerts(spark, store)
    assert kept.count() == 1000 and kept.filter("cast(source as int) < 1000").count() == 1000


def test_copies_of_a_version_do_not_depend_on_their_order(spark, tmp_path):
    rows = [("a", datetime(2025, 1, 1), 1.0), ("a", datetime(2025, 1, 1), 2.0)]
    stored = []
    for name, some in (("x", rows), ("y", rows[::-1])):
        batch = spark.createDataFrame(some, f"city string, {S.TIME} timestamp, v double").withColumn(feature_table.INGESTED, F.lit(datetime(2025, 1, 2)).cast("timestamp"))
        feature_table.upsert(spark, str(tmp_path / name), batch.coalesce(1))
        stored.append([r.v for r in feature_table.read_table(spark, str(tmp_path / name)).collect()])
    assert stored == [[2.0], [2.0]]
