"""Lags, rolling statistics and targets by the clock against plain Python, cut and uncut."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.checks import views as V
from skygrain.operators import features as FE
from skygrain.operators.ordered import ordered

START = datetime(2025, 1, 1)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    """Two cities with gaps of up to four days, repeated times, half hours, missing values; one city holds most rows."""
    pick, out = random.Random(5), []
    for city, n in (("A", 700), ("B", 40)):
        at = START
        for i in range(n):
            at += timedelta(hours=pick.choice([0, 0.5, 1, 1, 1, 1, 2, 7])) if pick.random() < 0.985 else timedelta(hours=pick.randrange(20, 100))
            out.append((city, at, len(out), None if pick.random() < 0.1 else float(pick.randrange(400))))
    return out


def _expected(rows):
    out = {}
    for city, at, i, _ in rows:
        mine = [r for r in rows if r[0] == city]
        found = {}
        for h in (-1, -6, 6, 72):
            same = [r for r in mine if r[1] == at + timedelta(hours=h)]
            found[h] = max(same, key=lambda r: r[2])[3] if same else None
        for w in S.ROLLING_WINDOWS:
            values = [r[3] for r in mine if at - timedelta(hours=w) < r[1] <= at and r[3] is not None]
            found["mean", w] = np.mean(values) if values else None
            found["std", w] = np.std(values, ddof=1) if len(values) > 1 else None
        out[i] = found
    return out


@pytest.mark.parametrize("limit", [25, 100_000])
def test_equals_plain_python(spark, rows, limit):
    df = spark.createDataFrame(rows, "city string, timestamp timestamp, event_id long, v double").repartition(7)
    df, by = FE.aligned_order(df.withColumn("aqi", F.col("v")), V.ORDER)
    o = ordered(df, ["city"], by, limit=limit, back_range=48.0 * FE.HOUR, ahead_range=72.0 * FE.HOUR)
    assert o.split == (limit == 25)
    w = FE.by_time(o)
    made = {**FE.aligned_shifts(w, ["event_id"], ["v"]), **FE.aligned_targets(w, ["event_id"], [6, 72])}
    got = o.finish(FE.with_aligned_rolling(o.frame, ["v"], w).select("*", *[e.alias(n) for n, e in made.items()])).collect()
    expected = _expected(rows)
    assert len(got) == len(rows)
    for r in got:
        e = expected[r.event_id]
        assert (r.v_lag_1h, r.v_lag_6h, r.aqi_h6, r.aqi_h72) == (e[-1], e[-6], e[6], e[72])
        for size in S.ROLLING_WINDOWS:
            for stat in ("mean", "std"):
                want = e[stat, size]
                assert r[S.rolling_name("v", stat, size)] == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))


def test_hours_without_gaps_are_rows(spark):
    """On complete hours both alignments give the same table, cut or not."""
    df = spark.range(400).select(
        F.when(F.col("id") < 300, "A").otherwise("B").alias("city"), F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"),
        *[((F.col("id") * (i + 3)) % 97 + 0.0).alias(c) for i, c in enumerate([*S.POLLUTANTS, *S.WEATHER])])
    by_rows = FE.engineer(df, horizons=S.HORIZONS).toPandas().sort_values(["city", "timestamp"]).reset_index(drop=True)
    for limit in (50, 100_000):
        by_time = FE.engineer(df, align="time", horizons=S.HORIZONS, limit=limit).toPandas().sort_values(["city", "timestamp"]).reset_index(drop=True)
        assert set(by_time.columns) == set(by_rows.columns)
        for c in by_rows.columns:
            if c in ("city", "timestamp"):
                assert (by_rows[c] == by_time[c]).all()
            else:
                np.testing.assert_allclose(by_time[c].astype(float), by_rows[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_missing_times_and_unknown_alignment(spark):
    """Rows without a time have no neighbours in time; a table of them alone has no value at all."""
    rows = [("A", None, 1, 5.0), ("A", START, 2, 7.0), ("A", START + timedelta(hours=1), 3, 8.0), ("A", None, 4, 6.0)] * 8
    df = spark.createDataFrame(rows, "city string, timestamp timestamp, event_id long, v double")
    for limit in (10, 1000):
        got, by = FE.aligned_order(df, V.ORDER)
        o = ordered(got, ["city"], by, limit=limit, back_range=6.0 * FE.HOUR)
        out = o.finish(o.frame.select("*", *[e.alias(n) for n, e in FE.aligned_shifts(FE.by_time(o), ["event_id"], ["v"]).items()])).collect()
        assert len(out) == len(rows) and {r.v_lag_1h for r in out if r.event_id == 3} == {7.0} and {r.v_lag_6h for r in out if r.event_id != 3} <= {None, 5.0, 6.0}
        assert {r.v_lag_1h for r in out if r.event_id == 2} == {None}
    with pytest.raises(ValueError):
        FE.engineer(df, align="weeks")


def test_one_exchange(spark):
    plan = FE.engineer(V.obs(spark, SF), ["city"], V.ORDER, align="time", horizons=S.HORIZONS)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("Exchange") == 1 and initial.count("Sort [") == 1
