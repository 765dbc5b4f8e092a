"""Hard negatives by the vertical scan against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain.llm import bond, queries
from test_kdtree import SF


def _brute(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """rows: (id, label, vector); anchors: ids. The rows that ``mine`` gives."""
    out = []
    for a in sorted(anchors):
        _, label, v = min((r for r in rows if r[0] == a), key=lambda r: (r[1], r[2]))
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in rows if i != a and len(w) == len(v)), key=lambda s: s[:2])
        near = [(-s, i) for s, i, lab in scored if lab == label][:positives]
        for place, (p, i) in enumerate(near, 1):
            hard = [(-s, j) for s, j, lab in scored if lab != label and low * p <= -100 * s <= high * p][:negatives]
            out += [(a, i, rank, j, p, n, place) for rank, (n, j) in enumerate(hard, 1)]
    return sorted(out)


def _found(frame):
    return sorted(tuple(r) for r in frame.collect())


def _quantised(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    return [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(x))) for x in r.embedding]) for r in rows]


def test_query(spark):
    rows = _quantised(spark)
    expected = _brute(rows, [i for i, _, _ in rows if i % 100 == 0])
    assert expected and _found(queries.op11_hard_negatives(spark, SF)) == expected


@pytest.mark.parametrize("block", [9, 64, 8192])
def test_blocks_ties_repeats_and_hot_label(spark, monkeypatch, block):
    monkeypatch.setattr(bond, "BLOCK_ROWS", block)
    monkeypatch.setattr(bond, "BLOCK_ANCHORS", 4)
    pick = np.random.default_rng(7)
    rows = [(i, int(pick.integers(0, 4)) if i % 3 else 1, pick.integers(-6, 7, 12).tolist()) for i in range(-40, 160)]
    rows += [(200 + i, i % 2, [3] * 12) for i in range(60)]                        # one vector for a quarter of the rows
    rows += [(20, 1, [5] * 12), (20, 1, [5] * 12), (20, 3, [4] * 12), (41, 1, [5] * 12), (41, 1, [5] * 12)]  # keys that repeat
    rows += [(400, 1, [7, 7]), (401, 1, [6, 8]), (402, 2, [4, 4]), (420, 9, []), (421, 9, []), (422, 8, []), (440, 77, [1] * 12)]
    nulls = [(None, 1, [1] * 12), (500, None, [1] * 12), (520, 1, None)]
    frame = spark.createDataFrame(rows + nulls, "vec_id long, label long, vector array<long>").withColumn("asked", F.lit("x")).withColumn("shard", F.lit(1))
    anchors = {i for i, _, _ in rows if i % 20 == 0}
    expected = _brute(rows, anchors)
    assert _found(bond.mine(frame, F.expr("vec_id % 20 = 0"))) == expected
    assert any(r[0] == 420 for r in expected) and any(r[0] == 400 for r in expected) and not any(r[0] == 440 for r in expected)
    assert _found(bond.mine(frame, F.expr("vec_id % 20 = 0"), positives_=2, negatives=3, low=-50, high=100)) == _brute(rows, anchors, 2, 3, -50, 100)


def test_scan_keeps_what_counts():
    pick = np.random.default_rng(1)
    points, anchor = pick.integers(-200, 200, (3000, 32)), pick.integers(-200, 200, 32)
    block = bond.Block(np.arange(3000), np.zeros(3000, int), points, 200.0)
    scores = points @ anchor
    order = np.lexsort((np.arange(3000), -scores))
    assert bond.best(block, anchor, np.ones(3000, bool), 7) == [(int(i), int(scores[i])) for i in order[:7]]
    windows = [(-1000, 5000), (5000, 60_000), (10**9, 2 * 10**9), (5, 4)]
    for (low, high), found in zip(windows, bond.inside(block, anchor, np.ones(3000, bool), windows, 4)):
        assert found == [(int(i), int(scores[i])) for i in order if low <= scores[i] <= high][:4]
    # the bounds do shrink the bitmap before the last column
    seen = []
    block.scan(anchor, np.ones(3000, bool), lambda least, greatest: (seen.append(len(least)), greatest >= np.partition(least, -5)[-5])[1])
    assert seen[0] == 3000 and seen[-1] < 600


def test_large_values_and_empty_tables(spark):
    big = 1 << 31
    rows = [(0, 1, [big, big]), (1, 1, [big, big]), (2, 2, [big, big // 2]), (3, 2, [-big, -big])]
    frame = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>")
    assert _found(bond.mine(frame, F.expr("vec_id = 0"))) == [(0, 1, 1, 2, (1 << 63) - 1, 3 << 61, 1)]
    assert bond.mine(frame.limit(0), F.expr("vec_id = 0")).count() == 0
    assert bond.mine(frame, F.expr("vec_id = 9")).count() == 0
