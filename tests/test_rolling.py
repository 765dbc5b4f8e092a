"""Rolling moments over spans of time against plain numpy, and that their cost does not grow with the rows of a span."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skygrain.operators import rolling
from skygrain.operators.ordered import ordered

MADE = [(f"{s}_{span}", "v", s, span) for span in (12, 24, 48) for s in ("mean", "std")]


def _batches(at, begins, v, size):
    whole = pa.table({"t": pa.array(at, pa.int64()), "b": begins, "v": pa.array(v, pa.float64())})
    return whole.to_batches(max_chunksize=size)


def _run(at, begins, v, size=7):
    return pa.Table.from_batches(rolling.spans(_batches(at, begins, v, size), "t", "b", MADE)).to_pydict()


@pytest.mark.parametrize("step", [1, 16, 1 << 16])
def test_equals_numpy(monkeypatch, step):
    monkeypatch.setattr(rolling, "STEP", step)
    pick = np.random.default_rng(3)
    at, begins, group = [], [], []
    for g, n in enumerate((1, 300, 2, 40, 150)):
        times = np.sort(pick.integers(0, 400, n))
        at += [None, *times.tolist()] if g % 2 else times.tolist()
        begins += [True] + [False] * (n - 1 + g % 2)
        group += [g] * (n + g % 2)
    v = [None if pick.random() < 0.2 else float(x) for x in 1e6 + pick.integers(0, 4, len(at)) / 8]
    got = _run(at, begins, v)
    for i in range(len(at)):
        for span in (12, 24, 48):
            frame = [v[j] for j in range(len(at)) if group[j] == group[i] and v[j] is not None
                     and (at[j] is None if at[i] is None else at[j] is not None and at[i] - span < at[j] <= at[i])]
            assert got[f"mean_{span}"][i] == pytest.approx(np.mean(frame), rel=1e-15) if frame else got[f"mean_{span}"][i] is None
            if len(frame) < 2:
                assert got[f"std_{span}"][i] is None
            elif len(set(frame)) == 1:
                assert got[f"std_{span}"][i] == 0.0
            else:
                assert got[f"std_{span}"][i] == pytest.approx(np.std(frame, ddof=1), rel=1e-9)


def test_special_values_stay_in_their_frames():
    at = list(range(0, 300, 5))
    v = [float(k % 7) for k in range(len(at))]
    v[10], v[30] = float("nan"), float("inf")
    got = _run(at, [True] + [False] * (len(at) - 1), v)
    for i, t in enumerate(at):
        frame = [x for x, s in zip(v, at) if t - 24 < s <= t]
        with np.errstate(invalid="ignore"):
            assert got["mean_24"][i] == pytest.approx(np.mean(frame), nan_ok=True)
            if len(frame) > 1:
                assert got["std_24"][i] == pytest.approx(np.std(frame, ddof=1), nan_ok=True, abs=1e-12)


def test_dense_frames_cost_little():
    """Frames of 40,000 rows: evaluated anew for each row these are 4e9 steps."""
    at = list(range(100_000))
    made = [("m", "v", "mean", 40_000), ("s", "v", "std", 40_000)]
    begin = time.perf_counter()
    got = pa.Table.from_batches(rolling.spans(_batches(at, [True] + [False] * 99_999, [float(t % 10) for t in at], 10_000), "t", "b", made))
    assert got.num_rows == 100_000 and time.perf_counter() - begin < 20


def test_chunks_follow_the_reach_of_dense_frames(spark):
    """A frame of 1,000 rows and chunks of 25 would send every row 40 times."""
    df = spark.range(4000).selectExpr("'A' as city", "id as t", "id as event_id")
    o = ordered(df, ["city"], ["t", "event_id"], limit=50, back_range=1000.0)
    assert o.split and 4000 < o.frame.count() <= 4 * 4000
    w = Window.partitionBy("city", "_chunk").orderBy("t").rangeBetween(-1000, 0)
    found = o.finish(o.frame.withColumn("n", F.count("*").over(w))).collect()
    assert {r.t: r.n for r in found} == {t: min(t, 1000) + 1 for t in range(4000)}


def test_rows_pass_once_in_the_feature_table(spark):
    """The sums of rolling frames are no window expressions of Spark, which evaluates a frame anew for every row."""
    from skygrain import schema as S
    from skygrain.operators.features import engineer
    columns = ", ".join(f"cast(id % 13 as double) as {c}" for c in S.POLLUTANTS + S.WEATHER)
    df = spark.range(200).selectExpr("'A' as city", "timestamp_seconds(id * 3600) as timestamp", *columns.split(", "))
    made = engineer(df)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(rowframe, -11" not in plan.lower() and "MapInArrow" in plan
    last = made.orderBy("timestamp").collect()[-1]
    values = [float(k % 13) for k in range(200)]
    assert last.pm10_rolling_mean_48h == pytest.approx(np.mean(values[-48:])) and last.pm10_rolling_std_12h == pytest.approx(np.std(values[-12:], ddof=1))


def test_linear_predictions_are_one_product(spark):
    from pyspark.ml.linalg import Vectors
    from skygrain.operators.gram import Linear, with_linear
    df = spark.range(50).selectExpr("id", "array(cast(id as double), 2D, id * 0.5D) as x")
    models = {"p": (Linear(Vectors.dense([3.0, 1.0]), 0.25), ("c", "a")), "q": (Linear(Vectors.dense([]), 7.0), ())}
    for r in with_linear(df, "x", ["a", "b", "c"], models).collect():
        assert (r.p, r.q) == (r.id * 1.0 + 1.5 * r.id + 0.25, 7.0)
    assert with_linear(df, "x", ["a", "b", "c"], models).columns == ["id", "p", "q"]
