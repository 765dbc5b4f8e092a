"""Quantiles of all columns of large groups at once against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain.operators import profile as P
from skygrain.operators import quantiles as Q

SHARES = [0.0, 0.25, 0.5, 0.73, 1.0]


@pytest.fixture(scope="module")
def rows():
    pick, out = np.random.default_rng(4), []
    for city, n in (("A", 900), (None, 500), ("C", 40)):
        for i in range(n):
            # many values within a range of 1e-6, few repeated ones with both zeros and infinities, missing ones
            v = float(pick.choice([-3.5, -0.0, 0.0, 1e-300, 7.25, float("inf"), float("-inf"), float("nan")]))
            out.append((city, 1.0 + float(pick.random()) * 1e-6, v if pick.random() < 0.9 else None, None))
    return out


@pytest.mark.parametrize("limit", [50, 600, 10_000])
def test_equals_numpy(spark, rows, limit):
    df = spark.createDataFrame(rows, "city string, a double, b double, c double").repartition(5)
    got = {(r.city, r.column): r.quantiles for r in Q.column_quantiles(df, ["a", "b", "c"], SHARES, ["city"], limit).collect()}
    assert set(got) == {(k, c) for k in ("A", None, "C") for c in "ab"}
    for (city, column), found in got.items():
        v = np.sort([r["abc".index(column) + 1] for r in rows if r[0] == city and r["abc".index(column) + 1] is not None and r["abc".index(column) + 1] == r["abc".index(column) + 1]])
        for share, x in zip(SHARES, found):
            low, high = v[int(np.floor(share * (len(v) - 1)))], v[int(np.ceil(share * (len(v) - 1)))]
            assert x == low if low == high else (not np.isfinite([low, high]).all() or low <= x <= high and x == pytest.approx(np.quantile(v[np.isfinite(v)], 0) * 0 + low + (share * (len(v) - 1) % 1) * (high - low), rel=1e-12))


@pytest.mark.parametrize("limit", [50, 10_000])
def test_without_keys(spark, rows, limit):
    df = spark.createDataFrame(rows, "city string, a double, b double, c double").select("a")
    row = Q.column_quantiles(df, ["a"], SHARES, (), limit).first()
    assert row.quantiles == pytest.approx(np.quantile([r[1] for r in rows], SHARES), rel=1e-14)


def test_large_tables_are_scanned_a_few_times(spark, tmp_path):
    """Eighteen columns of two groups: the rows themselves are read four times at most, whatever the number of columns."""
    path = str(tmp_path / "t")
    spark.range(3000).select((F.col("id") % 2).alias("city"), *[(F.col("id") * k % 977 / 16).alias(f"c{k}") for k in range(1, 19)]).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.read.parquet(path)
    watched = df.mapInArrow(look, df.schema)
    P.outlier_counts(watched, df.columns[1:], ["city"], limit=100).collect()
    # number of rows, sizes of groups, leading bits, values in the wanted ranges, groups below the limit, values outside
    assert seen.value <= 6 * 3000
