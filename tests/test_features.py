"""Features: column set, look-alikes in pandas, and independence of layout."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.checks import views as V
from skygrain.operators import features as FE
from skygrain.operators import profile as P
from skygrain.operators import series as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def obs(spark):
    return V.obs_null(spark, SF).drop("event_type").cache()


@pytest.fixture(scope="module")
def featured(spark, obs):
    df = FE.engineer(obs, ["city"], V.ORDER)
    return df.toPandas().sort_values(["city", *V.ORDER]).reset_index(drop=True)


def test_column_counts(spark, obs):
    df = FE.engineer(obs.drop("event_id"), ["city"])
    assert len(df.columns) == 118 and len(FE.feature_columns(df)) == 107
    assert "aqi" in FE.feature_columns(df, legacy=True)
    few = FE.engineer(obs.select("city", "timestamp", "pm10"), ["city"])
    assert "pm10_rolling_std_48h" in few.columns and "wind_chill" not in few.columns


def test_rolling_equals_pandas(featured):
    for city, g in featured.groupby("city"):
        for c in S.ROLLING_COLUMNS:
            for w in S.ROLLING_WINDOWS:
                r = g[c].astype(float).rolling(w, min_periods=1)
                np.testing.assert_allclose(g[S.rolling_name(c, "mean", w)], r.mean(), rtol=1e-9, atol=1e-9)
                np.testing.assert_allclose(g[S.rolling_name(c, "std", w)], r.std(), rtol=1e-6, atol=1e-6)
        assert (g["aqi_lag_6h"].dropna() == g["aqi"].shift(6).dropna()).all()


def test_constant_window_has_no_deviation(spark):
    df = spark.range(200).select(
        F.lit("A").alias("city"), F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"),
        F.when(F.col("id") < 100, F.rand(1) * 1e6).otherwise(0.1).alias("v"))
    from skygrain.operators.ordered import ordered
    o = ordered(df, ["city"], ["timestamp"], back=47)
    got = o.finish(FE.with_rolling(o.frame, ["v"], o.window)).orderBy("timestamp").toPandas()
    assert (got["v_rolling_std_48h"][147:] == 0).all() and (got["v_rolling_std_12h"][111:] == 0).all()
    assert got["v_rolling_mean_48h"][199] == pytest.approx(0.1, rel=1e-12)


def test_other_window_sizes(spark, obs):
    from skygrain.operators.ordered import ordered
    o = ordered(obs, ["city"], V.ORDER, back=20)
    got = o.finish(FE.with_rolling(o.frame, ["pm10"], o.window, [5, 10, 21])).toPandas()
    for _, g in got.sort_values(["city", *V.ORDER]).groupby("city"):
        for w in (5, 10, 21):
            np.testing.assert_allclose(
                g[f"pm10_rolling_std_{w}h"], g["pm10"].rolling(w, min_periods=1).std(), rtol=1e-7, atol=1e-9)


@pytest.mark.parametrize("limit", [100])
def test_cut_groups_and_shuffled_input(spark, obs, featured, limit):
    shuffled = obs.repartition(5, "pm10")
    got = FE.engineer(shuffled, ["city"], V.ORDER, limit=limit).toPandas()
    got = got.sort_values(["city", *V.ORDER]).reset_index(drop=True)[featured.columns]
    pd.testing.assert_frame_equal(got, featured, check_exact=False, rtol=1e-9)


def test_one_city_equals_filtered(spark, obs, featured):
    one = FE.engineer(obs.filter("city = 'C2'"), ["city"], V.ORDER).toPandas().sort_values(V.ORDER)
    same = featured[featured.city == "C2"].reset_index(drop=True)
    pd.testing.assert_frame_equal(one.reset_index(drop=True)[same.columns], same, rtol=1e-12)


def test_targets_and_split_when_cut(spark, obs):
    aqi = V.obs_aqi(spark, SF)
    for limit in (40, 10_000):
        df = FE.with_targets(aqi, ["city"], V.ORDER, limit=limit)
        assert df.count() == aqi.count() - 4 * 72
        split = T.chronological_split(aqi, ["city"], V.ORDER, limit=limit)
        shares = split.groupBy("city").agg(
            F.sum((F.col("split") == "train").cast("int")).alias("train"), F.count("*").alias("n")).collect()
        assert all(r.train == int(r.n * 0.8) for r in shares)


def test_one_exchange_one_sort(spark, obs):
    plan = FE.engineer(obs, ["city"], V.ORDER)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("Exchange") == 1 and initial.count("Sort [") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filter_reaches_the_scan(spark):
    from skygrain.functions.calendar import in_days
    events = spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("ts", "timestamp")
    plan = in_days(events, "2024-01-02", "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan.split("PushedFilters")[1]


def test_hourly_gaps_equal_pandas(spark):
    rows = [("A", 0, 1.0), ("A", 1, None), ("A", 5, 9.0), ("A", 9, None), ("A", 30, 4.0), ("B", 3, None), ("B", 4, 2.0)]
    df = spark.createDataFrame(rows, "city string, h int, aqi double").select(
        "city", F.timestamp_seconds(F.col("h") * 3600 + 60).alias("timestamp"), "aqi")
    got = T.hourly_series(df, ["aqi"]).orderBy("city", "timestamp").toPandas()
    for city, g in pd.DataFrame(rows, columns=["city", "h", "aqi"]).groupby("city"):
        s = g.set_index("h")["aqi"].reindex(range(g.h.min(), g.h.max() + 1)).interpolate(limit_direction="both")
        mine = got[got.city == city]
        np.testing.assert_allclose(mine["aqi"], s.to_numpy())
        np.testing.assert_allclose(mine["aqi_smooth"], s.rolling(6, min_periods=1).mean().to_numpy())


@pytest.mark.parametrize("segment", ["day", "month"])
def test_segments_carry_values_over_gaps(spark, segment):
    """Gaps longer than segments, a column without any value, and one absurd time: the same as one series per city."""
    rows = [("A", 0, 1.0, None), ("A", 30, None, None), ("A", 31, 7.0, None), ("A", 24 * 75, 3.0, None), ("A", 24 * 75 + 4, None, None), ("B", 23, None, None), ("B", 25, 2.0, None),
            ("C", 5, 4.0, 1.0)] + [("D", h, float(h % 7), float(h)) for h in range(700, 800, 3)] + [("D", 24 * 365 * 3, 9.0, None)]
    df = spark.createDataFrame(rows, "city string, h int, aqi double, x double").select(
        "city", F.timestamp_seconds(F.col("h") * 3600 + 600).alias("timestamp"), "aqi", "x").repartition(5)
    df = df.union(spark.createDataFrame([("A", None, 5.0, 5.0)], df.schema))
    got = T.hourly_series(df, ["aqi", "x"], segment=segment).orderBy("city", "timestamp").toPandas()
    for city, g in pd.DataFrame(rows, columns=["city", "h", "aqi", "x"]).groupby("city"):
        mine = got[got.city == city]
        for c in ("aqi", "x"):
            s = g.set_index("h")[c].reindex(range(g.h.min(), g.h.max() + 1)).astype(float).interpolate(limit_direction="both")
            np.testing.assert_allclose(mine[c].astype(float), s.to_numpy())
            if c == "aqi":
                np.testing.assert_allclose(mine["aqi_smooth"].astype(float), s.rolling(6, min_periods=1).mean().to_numpy(), atol=1e-9)


def test_profile_is_the_same_when_cut(spark, obs):
    columns = ["pm10", "pm2_5", "ozone", "latitude"]
    for build in (P.describe, P.distributions):
        a, b = (build(obs, columns, limit=n).toPandas().sort_values("column").reset_index(drop=True)
                for n in (50, 1_000_000))
        pd.testing.assert_frame_equal(a, b, rtol=1e-9)


@pytest.mark.parametrize("embargo", [0, 30])
def test_boundaries_mark_the_same_rows(spark, obs, embargo):
    for limit in (60, 10_000):
        expected = {r.event_id: r.split for r in T.chronological_split(
            obs, ["city"], V.ORDER, embargo=embargo).select("event_id", "split").collect()}
        cuts = T.split_boundaries(obs, ["city"], V.ORDER, embargo=embargo, limit=limit)
        here = F.struct(*V.ORDER)
        got = obs.join(cuts, "city").withColumn("split", F.when(here >= F.col("_test"), "test").when(
            here < F.col("_train_end"), "train")).filter("split is not null")
        assert {r.event_id: r.split for r in got.select("event_id", "split").collect()} == expected
