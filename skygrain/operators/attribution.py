"""How much each feature contributes to a forecast."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygrain.operators.forecast import VECTOR, Fitted
from skygrain.operators.gram import Linear


def method(fitted: Fitted) -> str:
    """Which attribution a model gets: "linear" or "tree"."""
    if isinstance(fitted.model, Linear):
        return "linear"
    if isinstance(fitted.model, RandomForestRegressionModel):
        return "tree"
    raise TypeError(f"no attribution for {type(fitted.model).__name__}")


def coefficient_table(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    """``(model, horizon, feature, coefficient)`` of linear models."""
    rows = [(f.algorithm, f.horizon, name, float(c))
            for f in fitted for name, c in zip(f.features, f.model.coefficients.toArray())]
    return spark.createDataFrame(
        rows, "model string, horizon int, feature string, coefficient double")


def feature_values(rows: DataFrame, features: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Feature vectors as long rows: carry, feature, value."""
    names = F.array(*[F.lit(f) for f in features])
    pairs = F.arrays_zip(names.alias("feature"), vector_to_array(VECTOR).alias("value"))
    return rows.select(*carry, F.explode(pairs).alias("_p")).select(
        *carry, F.col("_p.feature").alias("feature"), F.col("_p.value").alias("value"))


def feature_means(long: DataFrame) -> DataFrame:
    return long.groupBy("feature").agg(F.avg("value").alias("mean"))


def linear_contributions(
    long: DataFrame, coefficients: DataFrame, means: DataFrame, carry: Sequence[str]
) -> DataFrame:
    """``coefficient * (value - training mean)`` for every row and feature.

    Broadcast are one row per feature, and one per model, horizon and feature: their
    number depends on the models, not on the data.
    """
    known = coefficients.join(F.broadcast(means), "feature")
    return long.join(F.broadcast(known), "feature").select(
        *carry, "model", "horizon", "feature", "value",
        (F.col("coefficient") * (F.col("value") - F.col("mean"))).alias("contribution"))


def importance(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per model, horizon and feature."""
    return contributions.groupBy("model", "horizon", "feature").agg(
        F.avg(F.abs("contribution")).alias("importance"))


def top_features(importances: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important features per model and horizon; ties by name."""
    order = Window.partitionBy("model", "horizon").orderBy(F.desc("importance"), "feature")
    return importances.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def explanation(contributions: DataFrame, predictions: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Per row and model: prediction, contribution by feature, value by feature.

    Meant for single rows or small samples; a map has one entry per feature.
    """
    def by_feature(value: str):
        return F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", value))))

    keys = [*carry, "model", "horizon"]
    maps = contributions.groupBy(*keys).agg(
        by_feature("contribution").alias("feature_contributions"),
        by_feature("value").alias("feature_values"))
    return predictions.select(*keys, "prediction").join(maps, keys)


# --- trees ---------------------------------------------------------------------

def tree_nodes(spark: SparkSession, model_path: str) -> pd.DataFrame:
    """Nodes of a saved forest: at most ``trees * 2 ** (depth + 1)`` rows.

    The saved layout of a forest is read here and nowhere else.
    """
    raw = spark.read.parquet(f"{model_path}/data")
    return raw.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("value"), F.col("nodeData.rawCount").cast("double").alias("cover"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toPandas()


def leaf_boxes(nodes: pd.DataFrame) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Every leaf as its share of the forest's value and its box.

    A box has per feature on the path: index, lower bound (exclusive), upper bound
    (inclusive), and the share of training rows that stay on the path when the
    feature is unknown.
    """
    boxes = []
    trees = nodes["tree"].nunique()
    for _, tree in nodes.groupby("tree"):
        by_id = {n.id: n for n in tree.itertuples(index=False)}
        pending = [(0, {})]
        while pending:
            node_id, box = pending.pop()
            node = by_id[node_id]
            if node.left < 0:
                boxes.append((node.value / trees, [(f, *b) for f, b in sorted(box.items())]))
                continue
            low, high, share = box.get(node.feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((node.left, (low, min(high, node.threshold))),
                                  (node.right, (max(low, node.threshold), high))):
                part = share * by_id[child].cover / node.cover
                pending.append((child, {**box, node.feature: (*bounds, part)}))
    return boxes


def box_contributions(x: np.ndarray, boxes, features: int) -> tuple[np.ndarray, float]:
    """Shapley values of all rows: the sum over leaves of a closed form.

    In one leaf the value of a set of known features is the product of "row is
    inside" over known and of the training share over unknown features. The
    polynomial with factors ``share + inside * z`` collects the sets by size, and a
    set of size ``s`` out of ``d`` features has weight ``s! (d - s - 1)! / d!``.
    """
    out = np.zeros((len(x), features), order="F")
    x = np.asfortranarray(x)  # a feature at a time
    base = 0.0
    for value, box in boxes:
        d = len(box)
        base += value * float(np.prod([b[3] for b in box]))
        if not d:
            continue
        # which bounds hold is all a row brings: the form is worked out for each such pattern, not for each row
        pattern = np.zeros(len(x), np.int64)
        for j, (f, lo, hi, _) in enumerate(box):
            pattern |= ((x[:, f] > lo) & (x[:, f] <= hi)).astype(np.int64) << j
        patterns, place = (np.arange(1 << d), pattern) if d <= 6 else np.unique(pattern, return_inverse=True)
        inside = [(patterns >> j & 1).astype(float) for j in range(d)]
        weights = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
        for j, (feature, _, _, share) in enumerate(box):
            sizes = np.zeros((d, len(patterns)))
            sizes[0] = 1.0
            for i, (_, _, _, other) in enumerate(box):
                if i != j:
                    sizes[1:] = sizes[1:] * other + sizes[:-1] * inside[i]
                    sizes[0] *= other
            out[:, feature] += (value * (inside[j] - share) * np.tensordot(weights, sizes, 1))[place]
    return np.ascontiguousarray(out), base


def tree_contributions(
    rows: DataFrame, boxes_by_horizon: dict[int, list], features: Sequence[str],
    carry: Sequence[str], model: str = "random_forest",
) -> DataFrame:
    """Long contributions of forests, each horizon by its own forest.

    Trees of depth 5 are small enough to send to every task with the closure; the
    rows stay where they are.
    """
    carry, features = list(carry), list(features)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    spec = ", ".join(f"`{c}` {kinds[c]}" for c in carry)
    schema = f"{spec}, horizon int, base double, x array<double>, contribution array<double>"
    shared = rows.sparkSession.sparkContext.broadcast(boxes_by_horizon)

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["x"].to_numpy())
            for horizon, boxes in shared.value.items():
                values, base = box_contributions(x, boxes, len(features))
                yield batch[carry].assign(
                    horizon=horizon, base=base, x=list(x), contribution=list(values))

    vectors = rows.select(*carry, vector_to_array(VECTOR).alias("x"))
    names = F.array(*[F.lit(f) for f in features])
    long = F.arrays_zip(names.alias("feature"), F.col("x").alias("value"), F.col("contribution"))
    return vectors.mapInPandas(per_batch, schema).select(
        *carry, F.lit(model).alias("model"), "horizon", "base", F.explode(long).alias("_l")).select(
        *carry, "model", "horizon", "base", "_l.feature", "_l.value", "_l.contribution")
