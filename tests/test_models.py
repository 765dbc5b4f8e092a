"""Fits, metrics and attributions against closed forms."""

import itertools
import math
import uuid

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skygrain.operators import attribution as X
from skygrain.operators import forecast as FC
from skygrain.operators import gram as G
from skygrain.operators import metrics as M
from skygrain.session import scratch_root

NAMES = ("a", "b", "c", "flat", "d")


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) * [1, 30, 0.2, 0, 5] + [0, 1000, 3, 7, 0]
    x[:, 4] = np.round(x[:, 4])
    y = 3 * x[:, 0] + 0.1 * x[:, 1] - 8 * x[:, 2] * (x[:, 4] > 0) + rng.normal(size=400)
    rows = [(i, "train" if i < 320 else "test", [float(v) for v in x[i]], float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, split string, x array<double>, aqi_h1 double").select(
        "id", "split", array_to_vector("x").alias("features"), "aqi_h1").repartition(4, "id").sortWithinPartitions("id")
    return FC.TrainingSet(FC.durable(df, "t"), NAMES, {1: "aqi_h1"}), x, y


def test_ridge_equals_closed_form(training):
    t, x, y = training
    fitted = FC.fit(t, ["ridge_regression"])[0]
    assert fitted.features == ("a", "b", "c", "d")
    xt = x[:320][:, [0, 1, 2, 4]]
    xc, yc = xt - xt.mean(0), y[:320] - y[:320].mean()
    beta = np.linalg.solve(xc.T @ xc + 20.0 * np.eye(4), xc.T @ yc)
    assert fitted.model.coefficients.toArray() == pytest.approx(beta, rel=1e-9)
    assert fitted.model.intercept == pytest.approx(y[:320].mean() - xt.mean(0) @ beta, rel=1e-9)


def test_linear_contributions_add_up(spark, training):
    t, x, y = training
    fitted = FC.fit(t, ["ridge_regression"])
    assert X.method(fitted[0]) == "linear"
    long = X.feature_values(t.rows, NAMES, ["id", "split"])
    means = X.feature_means(long.filter("split = 'train'"))
    parts = X.linear_contributions(
        long.filter("split = 'test'"), X.coefficient_table(spark, fitted), means, ["id"])
    total = {r.id: r.s for r in parts.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    predicted = {r.id: r.prediction for r in FC.predict(fitted, t.rows, NAMES, ["id"]).collect()}
    centre = y[:320].mean()  # the prediction at the training means
    for i in range(320, 400):
        assert total[i] + centre == pytest.approx(predicted[i], abs=1e-8)


@pytest.fixture(scope="module")
def forest(spark, training):
    t, _, _ = training
    fitted = FC.fit(t, ["random_forest"])[0]
    path = f"{scratch_root(spark)}/forest-{uuid.uuid4().hex}"
    fitted.model.write().overwrite().save(path)
    return fitted, X.tree_nodes(spark, path)


def test_tree_contributions_add_up(spark, training, forest):
    t, x, y = training
    fitted, nodes = forest
    assert X.method(fitted) == "tree"
    boxes = X.leaf_boxes(nodes)
    long = X.tree_contributions(t.rows.filter("split = 'test'"), {1: boxes}, NAMES, ["id"])
    total = {r.id: r.s for r in long.groupBy("id").agg(
        (F.sum("contribution") + F.max("base")).alias("s")).collect()}
    predicted = {r.id: r.prediction for r in FC.predict([fitted], t.rows, NAMES, ["id"]).collect()}
    assert len(total) == 80
    for i, s in total.items():
        assert s == pytest.approx(predicted[i], abs=1e-8)


def test_tree_contributions_equal_enumeration(forest, training):
    """Shapley values of one tree by walking every subset of features."""
    _, nodes = forest
    _, x, _ = training
    one = nodes[nodes.tree == 0].assign(tree=0)
    by_id = {n.id: n for n in one.itertuples(index=False)}

    def value(node, row, known):
        if node.left < 0:
            return node.value
        left, right = by_id[node.left], by_id[node.right]
        if node.feature in known:
            return value(left if row[node.feature] <= node.threshold else right, row, known)
        return (left.cover * value(left, row, known) + right.cover * value(right, row, known)) / node.cover

    got, base = X.box_contributions(x[:5], X.leaf_boxes(one), 5)
    assert base == pytest.approx(value(by_id[0], x[0], ()))
    for r in range(5):
        for j in range(5):
            others = [f for f in range(5) if f != j]
            phi = 0.0
            for size in range(5):
                for subset in itertools.combinations(others, size):
                    w = math.factorial(size) * math.factorial(4 - size) / math.factorial(5)
                    phi += w * (value(by_id[0], x[r], {*subset, j}) - value(by_id[0], x[r], set(subset)))
            assert got[r, j] == pytest.approx(phi, abs=1e-9)


def test_forest_is_better_than_the_mean_and_repeats(training, forest):
    t, _, _ = training
    fitted, nodes = forest
    again = FC.fit(t, ["random_forest"])[0]
    trees = lambda f: f.model.toDebugString.split("\n", 1)[1]  # noqa: E731 - the first line holds a random name
    assert trees(again) == trees(fitted)
    test = FC.evaluate([fitted], t).filter("split = 'test'").first()
    assert test.r2 > 0.2 and test.n == 80


def test_metric_edge_cases(spark):
    rows = [("flat", 5.0, 4.0), ("flat", 5.0, 7.0), ("none", None, 1.0), ("none", float("nan"), 1.0),
            ("clip", 500.0, 900.0), ("clip", 0.0, -20.0), ("inf", float("inf"), 3.0), ("inf", 2.0, 3.0),
            ("inf", 4.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, actual double, prediction double")
    got = {r.g: r for r in M.regression_metrics(df, ["g"]).collect()}
    assert (got["flat"].mse, got["flat"].mae, got["flat"].r2) == (2.5, 1.5, -1.0)
    assert (got["none"].n, got["none"].mse, got["none"].r2) == (0, None, -1.0)
    assert (got["clip"].mae, got["clip"].r2) == (0.0, 1.0)
    assert (got["inf"].n, got["inf"].mae, got["inf"].r2) == (2, 0.5, 0.5)


def test_rollups_with_missing_fields(spark):
    rows = [("m1", 1, "rf", (1.0, 2.0, 0.5), "2025-01-01"), ("m2", 1, None, (1.0, None, 0.9), None),
            ("m3", None, "rf", (1.0, 1.0, None), "2025-01-02"), ("m4", 6, "rr", (1.0, 2.0, 0.9), "2025-01-01")]
    df = spark.createDataFrame(
        rows, "model_name string, horizon int, algorithm string, metrics struct<mse:double,mae:double,r2:double>,"
              " training_timestamp string").withColumns({"version": F.lit(None).cast("string")})
    flat = M.flat_records(df)
    best = M.best_models(flat).first()
    assert (best.total_models, best.best_mae_model, best.best_mae) == (4, "m3", 1.0)
    assert (best.best_r2_model, best.best_r2) == ("m2", 0.9)
    assert [r.model_name for r in M.model_ranking(flat).collect()] == ["m2", "m4", "m1", "m3"]
    by_h = {r.horizon: r for r in M.horizon_rollup(flat).collect()}
    assert set(by_h) == {1, 6}
    assert (by_h[1].best_mae, by_h[1].avg_mae, by_h[1].best_r2, by_h[1].model_count) == (2.0, 1.0, 0.9, 2)
    latest = {r.algorithm: r.model_name for r in M.latest_per_algorithm(flat).collect()}
    assert latest == {"rf": "m3", "unknown": "m2", "rr": "m4"}
    assert {r.algorithm: r.horizon for r in M.representative(
        flat.select("algorithm", "horizon", "mse", "mae", "r2").filter("horizon is not null")).collect()} == {
        "rf": 1, "rr": 6, "unknown": 1}


def test_gram_blocks_merge_in_any_order(spark):
    """Blocks of any sizes give the products of all rows, also far from zero, and a tree of merges the same."""
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(500, 4)) * [1, 30, 0.2, 5] + [1e6, -1000, 3, 0]
    names, apart = ("a", "b", "c", "y"), rows - rows.mean(0)
    parts = [G.block(names, p) for p in np.split(rows, [0, 1, 7, 300, 300])]
    for order in (parts, parts[::-1], parts[2:] + parts[:2]):
        total = order[0]
        for part in order[1:]:
            total = total.merge(part)
        assert total.n == 500
        np.testing.assert_allclose(total.mean, rows.mean(0), rtol=1e-12)
        np.testing.assert_allclose(total.products, apart.T @ apart, rtol=1e-9, atol=1e-9)
    missing = [(None, 1.0, 2.0, 3.0), (1.0, float("nan"), 2.0, 3.0)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows] + missing, "a double, b double, c double, y double").repartition(23)
    found = G.gram(df, names, width=3)  # 23 blocks, then 8, then 3
    assert found.n == 500
    np.testing.assert_allclose(found.products, apart.T @ apart, rtol=1e-9, atol=1e-9)
    w, intercept = found.ridge(("a", "c"), "y", 2.5)
    x = apart[:, [0, 2]]
    np.testing.assert_allclose(w, np.linalg.solve(x.T @ x + 2.5 * np.eye(2), x.T @ apart[:, 3]), rtol=1e-8)
    assert intercept == pytest.approx(rows[:, 3].mean() - w @ rows.mean(0)[[0, 2]])
    empty = G.gram(df.limit(0), names)
    assert empty.n == 0 and empty.varying(names) == []


def test_constant_columns_do_not_vary():
    rows = np.column_stack([np.full(1000, 0.1), np.full(1000, 1e9 + 0.3), np.zeros(1000), np.arange(1000) * 1e-9 + 1.0])
    assert G.block(("a", "b", "c", "d"), rows).varying(("a", "b", "c", "d")) == ["d"]


def test_written_vectors_train_as_their_columns_do(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "train" if i % 5 else "test", *map(float, rng.normal(size=2)), float(i % 7)) for i in range(300)]
    wide = spark.createDataFrame(rows, f"id int, split string, a double, b double, {FC.S.TARGET} double")
    wide = wide.withColumn("a", F.when(F.col("id") != 4, F.col("a")))
    narrow = FC.vectors(wide, ["id", "split"], ["a", "b"])
    assert narrow.columns == ["id", "split", FC.VECTOR, FC.S.TARGET] and narrow.count() == 299
    one, other = (FC.fit_single(wide, rows, ["a", "b"], ["ridge_regression"])[1].orderBy("split").collect() for rows in (wide, narrow))
    assert [r.n for r in one] == [r.n for r in other] == [60, 239]
    assert [x for r in one for x in (r.mse, r.mae, r.r2)] == pytest.approx([x for r in other for x in (r.mse, r.mae, r.r2)])


def test_fits_run_side_by_side_only_to_fill_the_cores():
    assert FC.side_by_side(parts=2, cores=12, parallel=4) == 4
    assert FC.side_by_side(parts=24, cores=12, parallel=4) == 2
    assert FC.side_by_side(parts=500, cores=12, parallel=4) == 1
