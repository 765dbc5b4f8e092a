"""Cutting large groups must not change any result."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain.operators.ordered import cut_large_groups, ordered
from skygrain.operators.quantiles import quantiles


def _rows():
    rng = random.Random(5)
    rows = []
    for i in range(400):  # hot, bursty: most rows within a second, and repeated times
        t = 1000 + (rng.randrange(40) if i < 300 else rng.randrange(10_000_000))
        rows.append(("hot", t, i, rng.gauss(0, 5)))
    for i in range(40):
        rows.append(("small", 5 * i, 1000 + i, float(i)))
    for i in range(90):  # every row at the same time: only the tie-break orders
        rows.append(("tied", 77, 2000 + i, float(i % 7)))
    for i in range(60):
        rows.append((None, i, 3000 + i, float(i % 11)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), "city string, t long, id long, v double").select(
        "city", F.timestamp_micros("t").alias("timestamp"), "id", "v")


@pytest.mark.parametrize("limit", [16, 50, 10_000])
def test_windows_equal_python(spark, table, limit):
    o = ordered(table, ["city"], ["timestamp", "id"], back=5, ahead=7, limit=limit)
    got = o.finish(o.frame.select(
        "*",
        F.lag("v", 5).over(o.window).alias("lag5"),
        F.lead("v", 7).over(o.window).alias("lead7"),
        F.sum("v").over(o.window.rowsBetween(-4, 0)).alias("roll"),
        o.position.alias("pos"), o.size.alias("n"))).collect()
    assert len(got) == 590
    groups = {}
    for city, t, i, v in _rows():
        groups.setdefault(city, []).append((t, i, v))
    expected = {}
    for city, rows in groups.items():
        rows.sort()
        vs = [r[2] for r in rows]
        for p, (t, i, v) in enumerate(rows):
            expected[i] = (vs[p - 5] if p >= 5 else None,
                           vs[p + 7] if p + 7 < len(vs) else None,
                           sum(vs[max(0, p - 4):p + 1]), p, len(vs))
    for r in got:
        lag5, lead7, roll, pos, n = expected[r.id]
        assert (r.lag5, r.lead7, r.pos, r.n) == (lag5, lead7, pos, n)
        assert r.roll == pytest.approx(roll)
    assert o.split == (limit < 400)


def test_no_slot_is_too_full(spark, table):
    slots = cut_large_groups(table, ["city"], ["timestamp", "id"], 16)
    rows = slots.table.collect()
    assert max(r._rows for r in rows) <= 16
    assert sum(r._rows for r in rows) == 590
    assert slots.tag(table).count() == 590


@pytest.mark.parametrize("limit", [8, 64, 10_000])
def test_quantiles_equal_numpy(spark, table, limit):
    shares = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    got = {r.city: r.quantiles for r in quantiles(table, ["city"], "v", shares, limit).collect()}
    groups = {}
    for city, _, _, v in _rows():
        groups.setdefault(city, []).append(v)
    assert set(got) == set(groups)
    for city, vs in groups.items():
        assert got[city] == pytest.approx(list(np.quantile(vs, shares)), rel=1e-12, abs=1e-12)


def test_quantiles_with_infinities_do_not_depend_on_the_limit(spark):
    from skygrain.operators.quantiles import quantiles

    values = [float("inf")] * 60 + [k / 10 for k in range(38)] + [float("nan"), float("-inf")]
    frame = spark.createDataFrame([("a", v) for v in values], "city string, v double")
    whole, cut = ([str(v) for v in quantiles(frame, ["city"], "v", [0.0, 0.25, 0.5, 0.99, 1.0], limit).first().quantiles] for limit in (10_000, 8))
    assert whole == cut


def test_chunks_send_few_rows_twice_and_fill_many_tasks(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("city"), F.timestamp_micros("id").alias("timestamp"), "id")
    o = ordered(rows, ["city"], ["timestamp", "id"], back=5, ahead=7, limit=2_000)
    assert o.frame.count() <= 1.2 * 20_000  # whole slots of neighbours come along
    assert o.frame.select(F.spark_partition_id()).distinct().count() > 16
    assert o.finish(o.frame).count() == 20_000
