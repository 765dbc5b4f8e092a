"""Exact top-k against brute force."""

import math

import duckdb
import numpy as np
import pytest

from skygrain.llm import kdtree, queries

SF = "/root/testdata/sf0.001"


def _brute(rows, asked, k):
    """rows: (id, integer vector); asked: ids."""
    out = set()
    for i, q in asked:
        scores = sorted((-sum(a * b for a, b in zip(v, q)), j) for j, v in rows if j != i and len(v) == len(q))
        out |= {(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)}
    return out


def test_query(spark):
    rows = [(r.vec_id, [math.floor(256 * float(x)) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = queries.op10_top_k(spark, SF).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == _brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert len(found) == 5 * sum(i % 50 == 0 for i, _ in rows)


@pytest.mark.parametrize("shard", [7, 50, 8192])
def test_shards_ties_and_repeats(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 5)
    pick = np.random.default_rng(2)
    rows = [(i, pick.integers(-3, 4, 4).tolist()) for i in range(-60, 140)] + [(200 + i, [1, 1, 1, 1]) for i in range(90)]
    rows += [(7, [9, 9, 9, 9]), (7, [9, 9, 9, 9]), (400, [1, 2]), (450, [3, 1]), (500, []), (550, [2, 2, 2])]
    frame = spark.createDataFrame([*rows, (None, [1, 1, 1, 1]), (600, None)], "vec_id long, vector array<long>")
    found = kdtree.top_k(frame, frame.filter("vec_id % 50 = 0"), 5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(_brute(rows, [r for r in rows if r[0] % 50 == 0], 5))


def test_tree_finds_the_best_at_every_leaf_size():
    pick = np.random.default_rng(4)
    points, ids = pick.integers(-50, 50, (700, 6)).astype(float), pick.permutation(700)
    points[100:400] = points[100]
    queries_ = np.concatenate([pick.integers(-50, 50, (20, 6)).astype(float), points[100:103], np.zeros((1, 6))])
    for leaf in (1, 16, 1000):
        tree = kdtree.Tree(ids, points, leaf)
        for q, bound in zip(queries_, tree.bounds(queries_)):
            expected = sorted(((int(p @ q), -int(i)) for i, p in zip(ids, points) if i != 5), reverse=True)[:5]
            assert tree.search(q, 5, bound, 5, None) == [(s, -i) for s, i in expected]
            assert tree.search(q, 5, bound, 5, expected[-1][0]) == [(s, -i) for s, i in expected]


def test_quantised_and_large_values(spark):
    rows = [(50, [0.5, -0.001]), (1, [float("nan"), 1.0]), (2, [float("inf"), 1.0]), (3, [None, 1.0]), (4, None), (5, [1e12, 1e-9]), (100, [-1e12, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.select("vec_id", kdtree.quantised(frame["embedding"]).alias("vector"))
    assert {r.vec_id: r.vector for r in frame.collect()} == {
        50: [128, -1], 1: None, 2: None, 3: None, 4: None, 5: [256 * 10**12, 0], 100: [-256 * 10**12, 768]}
    found = kdtree.top_k(frame, frame.filter("vec_id % 50 = 0"), 2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [
        (50, 1, 5, 128 * 256 * 10**12), (50, 2, 100, -128 * 256 * 10**12 - 768),
        (100, 1, 50, -128 * 256 * 10**12 - 768), (100, 2, 5, -(1 << 63))]
    assert kdtree.top_k(frame.limit(0), frame.limit(0), 3).count() == 0


def test_repeated_ids_as_in_sql(spark):
    """A query id that repeats asks once, with its smallest vector; repeated candidates are points of their own."""
    rows = [(50, [0.5, 0.25]), (50, [0.125, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (100, [0.25, 0.75]), (100, [0.25, 0.75]), (3, [None, 1.0]), (4, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = kdtree.top_k(frame.select("vec_id", kdtree.quantised(frame["embedding"]).alias("vector")), frame.filter("vec_id % 50 = 0").select(
        "vec_id", kdtree.quantised(frame["embedding"]).alias("vector")), 5)
    con = duckdb.connect()
    con.register("rows", frame.toPandas())
    con.execute("create view embeddings as select vec_id, cast(embedding as float[]) as embedding from rows")
    assert sorted(tuple(r) for r in found.collect()) == sorted(con.execute(queries.ORACLES["op10_top_k"]).fetchall())
