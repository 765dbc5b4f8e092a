"""Hand-computed cases of the column expressions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skygrain.functions import alert_text, calendar, index, numbers, weather
from skygrain.operators import alerts as AL
from skygrain.operators import profile as P


def _sub(spark, bands, decimals, values, policy="cap"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double")
    rows = df.select("i", index.sub_index("c", bands, decimals, policy).alias("x")).collect()
    return [r.x for r in sorted(rows, key=lambda r: r.i)]


def test_band_edges(spark):
    assert _sub(spark, index.PM25, 1, [0.0, 12.0, 12.1, 35.4, 35.5, 500.4, 500.5, 15.0, 45.0]) == [
        0, 50, 51, 100, 101, 500, 500, 57, 124]
    assert _sub(spark, index.O3, 0, [200.0, 201.0, 106.0, 105.0]) == [300, 500, 201, 200]


def test_missing_and_negative(spark):
    assert _sub(spark, index.PM25, 1, [None, float("nan"), -1.0]) == [None, None, None]


TABLES = {"pm25": (index.PM25, 1), "pm10": (index.PM10, 0), "o3": (index.O3, 0),
          "no2": (index.NO2, 0), "so2": (index.SO2, 0), "co": (index.CO, 1)}


@pytest.mark.parametrize("name", TABLES)
def test_every_edge_and_gap(spark, name):
    bands, decimals = TABLES[name]
    edges = [float(v) for b in bands for v in b[:2]]
    indices = [float(v) for b in bands for v in b[2:]]
    assert _sub(spark, bands, decimals, edges) == indices
    middles = [(a[1] + b[0]) / 2 for a, b in zip(bands, bands[1:])]
    assert _sub(spark, bands, decimals, middles) == [500.0] * len(middles)
    assert _sub(spark, bands, decimals, middles, "truncate") == [float(b[3]) for b in bands[:-1]]


@pytest.mark.parametrize("name", TABLES)
def test_grid_equals_python(spark, name):
    bands, decimals = TABLES[name]

    def expected(c):
        inside = [b for b in bands if b[0] <= c <= b[1]]
        if not inside:
            return 500
        lo, hi, il, ih = inside[0]
        return round(((ih - il) / (hi - lo)) * (c - lo) + il)

    step = 0.05 if decimals else 0.5
    grid = [round(i * step, 2) for i in range(int(bands[-1][1] * 1.1 / step))]
    assert _sub(spark, bands, decimals, grid) == [expected(c) for c in grid]


def test_overall_and_category(spark):
    df = spark.createDataFrame(
        [(1, 10.0, None, None), (2, None, None, None), (3, 15.0, 45.0, 300.0)],
        "i int, pm2_5 double, pm10 double, ozone double")
    out = index.with_aqi(df).select("i", "aqi", index.category(F.col("aqi")).alias("c")).orderBy("i").collect()
    assert [r.aqi for r in out] == [42, None, 201 + round(99 / 94 * 44)]
    assert [(r.c.category, r.c.level) for r in out] == [("Good", 1), ("Unknown", 0), ("Very Unhealthy", 5)]
    assert "ozone_ppb" in index.with_aqi(df).columns and "carbon_monoxide_ppm" not in index.with_aqi(df).columns


@pytest.mark.parametrize("aqi,name,color", [
    (50, "Good", "green"), (51, "Moderate", "yellow"), (100, "Moderate", "yellow"),
    (150, "Unhealthy for Sensitive Groups", "orange"), (200, "Unhealthy", "red"),
    (300, "Very Unhealthy", "purple"), (301, "Hazardous", "maroon")])
def test_bounds(spark, aqi, name, color):
    r = spark.range(1).select(index.category(F.lit(aqi)).alias("c"), index.gauge(F.lit(aqi)).alias("g")).first()
    assert (r.c.category, r.g.level, r.g.color) == (name, name, color)


def test_numbers(spark):
    r = spark.range(1).select(
        numbers.one_decimal_text(F.lit(59.25)).alias("text"),
        numbers.four_decimals(F.lit("1.00005")).alias("four"), numbers.four_decimals(F.lit("x")).alias("bad"),
        numbers.clip(F.lit(-3.0)).alias("low"), numbers.clip(F.lit(None)).alias("none"),
        weather.wind_chill(F.lit(10.0), F.lit(-1.0)).alias("chill"),
        calendar.parse_day(F.lit("2025-02-30")).alias("day"),
        calendar.minute_text(F.lit(datetime(2025, 1, 2, 3, 4, 59))).alias("minute")).first()
    assert (r.text, r.four, r.bad, r.low, r.none, r.chill, r.day, r.minute) == (
        "59.2", 1.0, None, 0.0, None, None, None, "2025-01-02 03:04")


def test_constant_column(spark):
    df = spark.range(10).select(F.lit(51.5).alias("lat"), F.col("id").cast("double").alias("v"),
                                (F.col("id") * -2.0).alias("w"), F.lit(None).cast("double").alias("none"))
    r = {(x.var1, x.var2): x.correlation for x in P.correlation_matrix(df, df.columns).collect()}
    assert r[("lat", "lat")] is None and r[("lat", "v")] is None and r[("none", "v")] is None
    assert r[("v", "v")] == 1.0 and r[("w", "v")] == pytest.approx(-1.0)
    d = {x.column: x for x in P.distributions(df, df.columns).collect()}
    assert d["lat"].std == 0 and d["lat"].skewness is None and "none" not in d
    h = P.histogram(df, ["lat"]).collect()
    assert [(x.bin, x.n) for x in h] == [(16, 10)]


def test_alert_golden(spark):
    """One check whose five alerts are known word by word."""
    now = datetime(2025, 10, 28, 19, 52, 31)
    current = spark.createDataFrame([("London", now, 120.5)], "city string, as_of timestamp, current double")
    predictions = spark.createDataFrame(
        [("London", now, h, m, v) for h, m, v in (
            (1, "random_forest", 125.0), (1, "ridge_regression", 118.0),
            (6, "random_forest", 130.0), (6, "ridge_regression", 122.0))],
        "city string, as_of timestamp, horizon int, model string, prediction double")
    rows = AL.build_alerts(AL.candidates(current, predictions)).collect()
    assert {(r.source, r.aqi_value) for r in rows} == {
        ("current", 120.5), ("1h_random_forest", 125.0), ("1h_ridge_regression", 118.0),
        ("6h_random_forest", 130.0), ("6h_ridge_regression", 122.0)}
    for r in rows:
        assert r.severity == "moderate" and r.threshold_exceeded == "Moderate (100+)"
        assert r.message == f"Unhealthy air quality for sensitive groups detected: AQI {r.aqi_value} ({r.source})"
        assert r.recommendations == alert_text.RECOMMENDATIONS["moderate"]


def test_missing_prediction_counts_as_current(spark):
    now = datetime(2025, 1, 1)
    current = spark.createDataFrame([("A", now, 160.0)], "city string, as_of timestamp, current double")
    predictions = spark.createDataFrame(
        [("A", now, 1, "m", None)], "city string, as_of timestamp, horizon int, model string, prediction double")
    assert {(r.source, r.aqi) for r in AL.candidates(current, predictions).collect()} == {
        ("current", 160.0), ("1h_m", 160.0)}


def test_alert_bounds(spark):
    values = [50.0, 50.1, 99.9, 100.0, 149.9, 150.0, 199.9, 200.0]
    df = spark.createDataFrame([(v, "s") for v in values], "aqi double, source string")
    got = {r.aqi_value: r.severity for r in AL.build_alerts(df).collect()}
    assert got == {50.1: "low", 99.9: "low", 100.0: "moderate", 149.9: "moderate",
                   150.0: "high", 199.9: "high", 200.0: "critical"}


def test_dedup_bounds(spark):
    now = datetime(2025, 1, 1, 12)
    schema = "city string, timestamp timestamp, aqi_value double, severity string, source string"
    def history(minutes, seconds, value, severity="low", source="current", city="A"):
        return (city, now - timedelta(minutes=minutes, seconds=seconds), value, severity, source)
    cases = [  # history row, kept?
        (history(59, 59, 70.0), False), (history(60, 0, 70.0), True),
        (history(5, 0, 74.9), False), (history(5, 0, 75.0), True),
        (history(5, 0, 65.1), False), (history(5, 0, 65.0), True),
        (history(5, 0, 70.0, "moderate"), True), (history(5, 0, 70.0, "low", "1h_m"), True),
        (history(5, 0, 70.0, "low", "current", "B"), True), (history(-30, 0, 70.0), False)]
    candidate = spark.createDataFrame([("A", now, 70.0, "low", "current")], schema)
    for row, kept in cases:
        left = AL.new_alerts(candidate, spark.createDataFrame([row], schema), now).count()
        assert left == int(kept), row


def test_summary_ties_and_empty(spark):
    now = datetime(2025, 1, 2)
    schema = "timestamp timestamp, aqi_value double, severity string, source string, message string"
    rows = [(now - timedelta(hours=h), v, "high", s, s) for h, v, s in (
        (1, 160.0, "a"), (2, 170.0, "b"), (3, 170.0, "c"), (25, 199.0, "old"))]
    s = AL.alert_summary(spark.createDataFrame(rows, schema), now).first()
    assert (s.total_alerts, s.high_count, s.low_count) == (3, 3, 0)
    assert (s.latest_alert.source, s.highest_aqi.source) == ("a", "b")
    e = AL.alert_summary(spark.createDataFrame([], schema), now).first()
    assert (e.total_alerts, e.critical_count, e.latest_alert) == (0, 0, None)
