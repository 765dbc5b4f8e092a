"""Exact-size splits and samples, global positions, quantiles with special values, counts without jobs."""

import math
import tempfile
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain.operators import selection
from skygrain.operators.quantiles import quantiles
from skygrain.plans.counts import Counts, read_counts
from skygrain.plans.store import Store
from skygrain.session import durable


def _keys(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id") % 7).alias("city"), "id")


@pytest.mark.parametrize("last", [100_000, 5])
def test_sizes_are_exact_at_any_layout(spark, monkeypatch, last):
    monkeypatch.setattr(selection, "LAST", last)
    df = _keys(spark, 3001)
    picked = {}
    for name, frame in (("a", df.repartition(3)), ("b", df.repartition(11, "city"))):
        split = selection.random_split(frame, ["city", "id"], 0.8)
        picked[name] = {r.id for r in split.filter("split = 'train'").collect()}
        assert split.count() == 3001 and len(picked[name]) == int(3001 * 0.8)
    assert picked["a"] == picked["b"]
    for n in (0, 1, 17, 3000, 3001, 5000):
        assert selection.sample_rows(df, n, ["city", "id"]).count() == min(n, 3001)
    # a sample is the head of any larger one, and another seed gives another one
    few, more = ({r.id for r in selection.sample_rows(df, n, ["city", "id"]).collect()} for n in (50, 500))
    assert few <= more and few != {r.id for r in selection.sample_rows(df, 50, ["city", "id"], seed=7).collect()}


def test_copies_of_a_key_stay_together(spark, monkeypatch):
    """A third of the rows share one key, or have none: they are all on one side, and no sort sees them."""
    monkeypatch.setattr(selection, "LAST", 5)
    rows = [("hot", 1)] * 400 + [(None, None)] * 100 + [(f"c{i}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "city string, id long")
    split = selection.random_split(df, ["city", "id"], 0.5).groupBy("city", "id").agg(F.count_distinct("split").alias("n")).collect()
    assert {r.n for r in split} == {1}
    train = selection.random_split(df, ["city", "id"], 0.5).filter("split = 'train'").count()
    assert 600 <= train < 600 + 400
    assert selection.random_split(df.limit(0), ["city", "id"], 0.5).count() == 0
    assert selection.sample_rows(df.limit(0), 5, ["city", "id"]).count() == 0


def test_positions(spark):
    rows = [(i, None if i % 10 == 0 else (i * 7919) % 50, "x" * (i % 3)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v long, t string").repartition(6)
    got = selection.sorted_table(df, [F.col("v").desc_nulls_last(), F.col("id")]).collect()
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert sorted((r.position, r.id) for r in got) == [(i, r[0]) for i, r in enumerate(order)]
    same = selection.sorted_table(df.withColumn("one", F.lit(1)), ["one"])
    assert sorted(r.position for r in same.collect()) == list(range(2000))
    # rows that all tie are dealt to several tasks
    assert same.select(F.col("position")).distinct().count() == 2000
    assert selection.sorted_table(df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("limit", [20, 100_000])
def test_quantiles_with_special_values(spark, limit):
    """Infinities and NaN by count: the same as Spark's percentile in one task, and the slots hold finite rows only."""
    inf, nan = float("inf"), float("nan")
    rows = [("a", float(i % 83)) for i in range(400)] + [("a", v) for v in [inf] * 90 + [-inf] * 60 + [nan] * 50]
    rows += [("b", inf)] * 50 + [("b", 1.0)] * 3 + [("c", nan)] * 40 + [("d", None)] * 30 + [("e", float(i)) for i in range(100)] + [("e", -inf)] * 300
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.05, 0.1, 0.25, 0.5, 0.75, 0.83, 0.9, 0.95, 1.0]
    got = {r.g: r.quantiles for r in quantiles(df, ["g"], "v", shares, limit).collect()}
    assert set(got) == {"a", "b", "c", "e"}
    for g, values in got.items():
        mine = sorted((v for k, v in rows if k == g and v is not None), key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0))
        for share, value in zip(shares, values):
            at = share * (len(mine) - 1)
            low, high = mine[math.floor(at)], mine[math.ceil(at)]
            expected = low if math.floor(at) == math.ceil(at) else (math.ceil(at) - at) * low + (at - math.floor(at)) * high
            np.testing.assert_allclose(value, expected, rtol=1e-12)


def test_counting_runs_no_job(spark):
    """A counted write takes as many jobs as one that is not counted."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    df = spark.range(1000).repartition(3).withColumn("x", F.lit(1))

    def jobs(write):
        group = f"count-{write.__name__}-{id(write)}"
        context.setJobGroup(group, group)
        out = write()
        found = len(tracker.getJobIdsForGroup(group))
        context.setJobGroup("after", "after")
        return out, found

    counts = Counts("test", datetime(2025, 1, 1))

    def plain():
        return durable(df, "plain")

    def counted():
        return counts.durable(df, "step")

    (_, expected), (out, found) = jobs(plain), jobs(counted)
    assert found == expected and out.count() == 1000
    counts.note("models", 3)
    store = Store(tempfile.mkdtemp(prefix="counts-"))
    assert read_counts(spark, store).count() == 0
    counts.write(spark, store)
    rows = read_counts(spark, store, counts.run_id).orderBy("position").collect()
    assert [(r.job, r.step, r.rows, r.columns) for r in rows] == [("test", "step", 1000, 2), ("test", "models", 3, 1)]
