"""Saved models, metric records, reports and attributions."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators.forecast import Fitted
from skygrain.operators.gram import Linear
from skygrain.sources.feature_table import table_exists

MODEL_BASE = "aqi_6h_forecast"
REGISTRY = (
    "name string, algorithm string, horizon int, version string, path string, class string, "
    "description string, features array<string>, mse double, mae double, r2 double")


def _kind(model: type) -> str:
    return f"{model.__module__}:{model.__name__}"


def _save_linear(spark: SparkSession, model: Linear, path: str) -> None:
    row = spark.createDataFrame([(model.coefficients.toArray().tolist(), model.intercept)], "coefficients array<double>, intercept double")
    row.coalesce(1).write.mode("overwrite").parquet(path)


def _load_linear(spark: SparkSession, path: str) -> Linear:
    row = spark.read.parquet(path).first()
    return Linear(Vectors.dense(row.coefficients), row.intercept)


# the kinds of model a registry row may name: how they are written and read
_KINDS = {
    _kind(Linear): (_save_linear, _load_linear),
    _kind(RandomForestRegressionModel): (
        lambda spark, model, path: model.write().overwrite().save(path),
        lambda spark, path: RandomForestRegressionModel.load(path)),
}


def model_name(algorithm: str) -> str:
    """The one place that names a multi-horizon model."""
    return f"{MODEL_BASE}_multi_output_{algorithm}"


def save_models(
    spark: SparkSession, root: str, fitted: list[Fitted], version: str,
    metrics: dict[tuple[str, int], tuple[float, float, float]] | None = None,
    description: str = "",
) -> None:
    """Write each model below ``root`` and append one registry row per model."""
    rows = []
    for f in fitted:
        name = model_name(f.algorithm)
        path = f"{root}/models/{name}/{version}/h{f.horizon}"
        kind = _kind(type(f.model))
        _KINDS[kind][0](spark, f.model, path)
        mse, mae, r2 = (metrics or {}).get((f.algorithm, f.horizon), (None, None, None))
        rows.append((name, f.algorithm, f.horizon, version, path, kind,
                     description, list(f.features), mse, mae, r2))
    spark.createDataFrame(rows, REGISTRY).coalesce(1).write.mode("append").parquet(f"{root}/registry")


def registered(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root}/registry")


def newest_versions(registry: DataFrame) -> DataFrame:
    """The newest row per name and horizon."""
    return registry.groupBy("name", "horizon").agg(
        F.max_by(F.struct(*registry.columns), "version").alias("r")).select("r.*")


def load_models(spark: SparkSession, root: str) -> list[tuple[Fitted, str]]:
    """The newest version of every registered model, with its path."""
    if not table_exists(spark, f"{root}/registry"):
        return []
    out = []
    for row in newest_versions(registered(spark, root)).orderBy("algorithm", "horizon").collect():
        model = _KINDS[row["class"]][1](spark, row["path"])
        out.append((Fitted(row["algorithm"], row["horizon"], model, tuple(row["features"])), row["path"]))
    return out


def write_metrics(records: DataFrame, path: str) -> None:
    """Append metric records as JSON, a folder per algorithm."""
    records.withColumn("algorithm_key", F.col("algorithm")).write.mode("append").partitionBy(
        "algorithm_key").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.METRIC_RECORD).json(path).select(*S.METRIC_RECORD.names)


def read_metric_files(spark: SparkSession, path: str) -> DataFrame:
    """Every ``*_metrics.json`` of a folder, named by its file stem.

    A file that cannot be read as a record is skipped.
    """
    raw = (spark.read.schema(S.METRIC_RECORD).option("multiLine", True).option("mode", "PERMISSIVE")
           .option("pathGlobFilter", "*_metrics.json").json(path))
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)_metrics\.json$", 1)
    readable = F.coalesce(*[F.col(c).cast("string") for c in ("model_name", "algorithm")],
                          F.col("metrics.mae").cast("string"), F.col("horizon").cast("string")).isNotNull()
    return raw.filter(readable).withColumn("model_name", F.url_decode(stem))


def write_section(df: DataFrame, root: str, section: str, run_id: str) -> None:
    """Store one part of a report or attribution run."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(
        f"{root}/{section}")


def read_section(
    spark: SparkSession, root: str, section: str, run_id: str | None = None
) -> DataFrame | None:
    """One run of a section, the latest by default; None if nothing is stored."""
    path = f"{root}/{section}"
    if not table_exists(spark, path):
        return None
    df = spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("string"))
    if run_id is None:
        run_id = df.agg(F.max("run_id")).first()[0]
    return df.filter(F.col("run_id") == run_id)


def run_stamp(moment: datetime) -> str:
    """A run or version name that sorts by time."""
    return moment.strftime("r%Y%m%dT%H%M%S%f")
