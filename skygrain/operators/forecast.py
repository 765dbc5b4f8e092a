"""Multi-horizon forecasts: preparation, ridge from one pass, forests with Spark ML, predictions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions.numbers import clip
from skygrain.operators.features import as_doubles, feature_columns, with_targets
from skygrain.operators.gram import Linear, gram_of_vectors, with_linear
from skygrain.operators.metrics import regression_metrics
from skygrain.operators.ordered import GROUP_LIMIT
from skygrain.operators.series import split_boundaries
from skygrain.session import durable, small_side

# Model settings.
FOREST = {"numTrees": 50, "maxDepth": 5, "minInstancesPerNode": 5, "seed": 42}
RIDGE_ALPHA = 20.0
# Fixed value: fewer rows train nothing.
LEAST_ROWS = 100
ALGORITHMS = ("random_forest", "ridge_regression")
VECTOR = "features"
# Tasks a core that fits side by side have in all: each holds its rows in memory from the first to the last level.
WAVES = 4


@dataclass(frozen=True)
class Fitted:
    """One model: an algorithm for one horizon, on the named features in order."""

    algorithm: str
    horizon: int
    model: object
    features: tuple[str, ...]


@dataclass(frozen=True)
class TrainingSet:
    """Written rows with a feature vector, targets and split."""

    rows: DataFrame
    features: tuple[str, ...]
    targets: dict[int, str]


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(features), outputCol=VECTOR, handleInvalid="error",
    ).transform(as_doubles(df, features))


def prepare(
    features: DataFrame,
    keys: Sequence[str] = S.KEYS,
    order: Sequence[str] = (S.TIME,),
    horizons: Sequence[int] = S.HORIZONS,
    share: float = S.TRAIN_SHARE,
    embargo: int = 0,
    limit: int = GROUP_LIMIT,
) -> TrainingSet | None:
    """Targets, chronological split and feature vectors, or None below 100 rows.

    The rows are written once in a fixed layout: every fit reads the same table, and
    a forest depends on how rows are spread.
    """
    columns = [c for c in feature_columns(features) if c not in {*keys, *order}]
    targets = {h: S.horizon_name(h) for h in horizons}
    labelled = with_targets(features, keys, order, horizons, limit)
    narrow = assemble(labelled.na.drop("any", subset=columns), columns).select(
        *keys, *order, VECTOR, *[F.col(t).cast("double").alias(t) for t in targets.values()])
    # spread by the hash of the whole key: even for one very long city, and without
    # the sampling pass of a range layout
    spread = narrow.repartition(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = durable(spread, "training")
    if rows.limit(LEAST_ROWS).count() < LEAST_ROWS:
        return None
    cuts = durable(split_boundaries(rows, keys, order, share, embargo, limit), "cuts")
    here = F.struct(*order)
    label = F.when(here >= F.col("_test"), "test").when(here < F.col("_train_end"), "train")
    marked = rows.join(small_side(cuts), list(keys), "left").withColumn("split", label)
    return TrainingSet(marked.drop("_test", "_train_end").filter(F.col("split").isNotNull()),
                       tuple(columns), targets)


def _slice(df: DataFrame, names: Sequence[str], wanted: Sequence[str], column: str) -> DataFrame:
    position = {n: i for i, n in enumerate(names)}
    return VectorSlicer(
        inputCol=VECTOR, outputCol=column, indices=[position[n] for n in wanted]).transform(df)


def fit_ridge(training: TrainingSet, alpha: float = RIDGE_ALPHA) -> list[Fitted]:
    """One ridge model per horizon, all from one pass over the training rows.

    Constant features are left out: they would get coefficient 0.
    """
    train = training.rows.filter(F.col("split") == "train")
    g = gram_of_vectors(train, VECTOR, training.features, list(training.targets.values()))
    varying = tuple(g.varying(training.features))
    out = []
    for horizon, target in training.targets.items():
        coefficients, intercept = g.ridge(varying, target, alpha)
        out.append(Fitted("ridge_regression", horizon, Linear(Vectors.dense(coefficients), intercept), varying))
    return out


def side_by_side(parts: int, cores: int, parallel: int) -> int:
    """Fits to run at a time: enough for ``WAVES`` tasks a core, at most ``parallel``."""
    return max(1, min(parallel, -(-WAVES * cores // max(1, parts))))


def fit(
    training: TrainingSet, algorithms: Sequence[str] = ALGORITHMS, parallel: int = 4
) -> list[Fitted]:
    """One model per algorithm and horizon; forests are fitted side by side on the cluster.

    At most ``parallel`` at a time, and fewer where the tasks of one keep all cores busy: each holds its training rows in memory.
    """
    if unknown := set(algorithms) - set(ALGORITHMS):
        raise ValueError(f"unknown algorithm {sorted(unknown)[0]!r}")
    train = training.rows.filter(F.col("split") == "train")
    names = training.features
    subset = str(max(1, math.isqrt(len(names))))

    def forest(horizon: int) -> Fitted:
        target = training.targets[horizon]
        estimator = RandomForestRegressor(featuresCol=VECTOR, labelCol=target, featureSubsetStrategy=subset, **FOREST)
        return Fitted("random_forest", horizon, estimator.fit(train.select(VECTOR, target)), names)

    fitted = {}
    if "ridge_regression" in algorithms:
        fitted["ridge_regression"] = fit_ridge(training)
    if "random_forest" in algorithms:
        parts = train.select(F.spark_partition_id()).distinct().count()
        with ThreadPool(side_by_side(parts, train.sparkSession.sparkContext.defaultParallelism, parallel)) as pool:
            fitted["random_forest"] = pool.map(inheritable_thread_target(train.sparkSession)(forest), list(training.targets))
    return [f for a in algorithms for f in fitted[a]]


def predict(
    fitted: Sequence[Fitted], df: DataFrame, names: Sequence[str], carry: Sequence[str],
    clipped: bool = False, actual: dict[int, str] | None = None,
) -> DataFrame:
    """Long predictions: ``carry``, horizon, model, prediction (and ``actual``).

    ``df`` has a vector of the features ``names``. At inference predictions are not
    bounded.
    """
    vectors = {tuple(names): VECTOR}
    linear = {f"_p{i}": (f.model, f.features) for i, f in enumerate(fitted) if isinstance(f.model, Linear)}
    if linear:
        needed = [c for c in df.columns if c in {*carry, *(actual or {}).values()} or c == VECTOR and len(linear) < len(fitted)]
        df = with_linear(df.select(*needed, vector_to_array(VECTOR).alias("_x")), "_x", names, linear)
    for i, f in enumerate(fitted):
        if f"_p{i}" in linear:
            continue
        if f.features not in vectors:
            vectors[f.features] = f"_v{i}"
            df = _slice(df, names, f.features, f"_v{i}")
        model = f.model.copy().setFeaturesCol(vectors[f.features]).setPredictionCol(f"_p{i}")
        df = model.transform(df)

    def entry(i: int, f: Fitted):
        value = F.col(f"_p{i}")
        fields = [F.lit(f.horizon).alias("horizon"), F.lit(f.algorithm).alias("model"),
                  (clip(value) if clipped else value).alias("prediction")]
        if actual:
            fields.append(F.col(actual[f.horizon]).alias("actual"))
        return F.struct(*fields)

    entries = F.array(*[entry(i, f) for i, f in enumerate(fitted)])
    return df.select(*carry, F.explode(entries).alias("_e")).select(*carry, "_e.*")


def one_horizon(predictions: DataFrame, horizon: int) -> DataFrame:
    return predictions.filter(F.col("horizon") == horizon)


def evaluate(fitted: Sequence[Fitted], training: TrainingSet) -> DataFrame:
    """Train and test metrics of all algorithms and horizons in one job."""
    scored = predict(fitted, training.rows, training.features, ["split"], actual=training.targets)
    return regression_metrics(scored, ["model", "horizon", "split"]).withColumnRenamed("model", "algorithm")


def vectors(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys``, vector and target of the rows that have all ``columns``, written once: the columns themselves are not."""
    narrow = assemble(rows.na.drop("any", subset=list(columns)), columns)
    return durable(narrow.select(*keys, VECTOR, F.col(S.TARGET).cast("double").alias(S.TARGET)), "vectors")


def fit_single(
    features: DataFrame, split: DataFrame, columns: Sequence[str],
    algorithms: Sequence[str] = ALGORITHMS,
) -> tuple[list[Fitted], DataFrame]:
    """The single-horizon forecaster on rows already marked "train" or "test".

    Rows that ``vectors`` has written have their vectors already and are read as they are.
    """
    target = {S.TARGET_HOURS: S.TARGET}
    if VECTOR in split.columns:
        rows = split.select("split", VECTOR, S.TARGET)
    else:
        narrow = assemble(split.na.drop("any", subset=list(columns)), columns).select(
            "split", VECTOR, F.col(S.TARGET).cast("double").alias(S.TARGET))
        rows = durable(narrow, "single")
    training = TrainingSet(rows, tuple(columns), target)
    fitted = fit(training, algorithms)
    return fitted, evaluate(fitted, training)


def forest_importance(spark, fitted: Fitted, top: int | None = None) -> DataFrame:
    """Split importance per feature of one forest, largest first."""
    values = fitted.model.featureImportances.toArray()
    rows = [(fitted.algorithm, fitted.horizon, name, float(v)) for name, v in zip(fitted.features, values)]
    df = spark.createDataFrame(
        rows, "model string, horizon int, feature string, importance double").orderBy(
        F.desc("importance"), "feature")
    return df.limit(top) if top else df
