"""Jobs on stored models: forecasts, alert check, attribution."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators import alerts as AL
from skygrain.operators import attribution as X
from skygrain.operators import forecast as FC
from skygrain.plans import state
from skygrain.plans.counts import Counts, written
from skygrain.plans.ingest import read_features, row_index
from skygrain.plans.model_report import attribution_summary
from skygrain.plans.store import Store
from skygrain.session import durable
from skygrain.sources import registry, versioned
from skygrain.sources.feature_table import sample_rows, table_exists

SUMMARY_HOURS = 24
HISTORY = (
    "city string, timestamp timestamp, aqi_value double, severity string, source string, message string, "
    "threshold_exceeded string, recommendations array<string>")


def _active(current: DataFrame, as_of: datetime, days: int | None) -> DataFrame:
    """Cities with a reading in the last ``days`` days; all of them by default."""
    return current if days is None else current.filter(F.col(f"at.{S.TIME}") >= F.lit(as_of - timedelta(days=days)))


def forecast_latest(
    spark: SparkSession, store: Store, current: DataFrame
) -> tuple[DataFrame | None, list[tuple[int, str]]]:
    """Long predictions of all registered models for cities whose newest row is complete, unbounded; and the models."""
    fitted = [f for f, _ in registry.load_models(spark, store.models)]
    if not fitted:
        return None, []
    names = list(max((f.features for f in fitted), key=len))
    names += sorted({n for f in fitted for n in f.features} - set(names))
    rows = FC.assemble(state.model_inputs(current), names)
    return FC.predict(fitted, rows, names, [*S.KEYS]), [(f.horizon, f.algorithm) for f in fitted]


def alert_check(
    spark: SparkSession, store: Store, as_of: datetime, active_days: int | None = None, counts: Counts | None = None
) -> tuple[DataFrame, DataFrame] | None:
    """Check current and predicted values, store the new alerts, and sum up 24 hours.

    Returns the new alerts and the summary per city, or None without features. A city whose newest row lacks a sensor is checked
    with its current value in place of every forecast. ``active_days`` leaves out cities silent for longer.
    """
    if not versioned.exists(spark, store.state):
        return None
    current = durable(_active(state.read(spark, store), as_of, active_days), "current")
    predictions, models = forecast_latest(spark, store, current)
    since = as_of - timedelta(hours=SUMMARY_HOURS)
    history = read_alerts(spark, store, since=since)
    found = AL.build_alerts(state.check_values(current, predictions, models, F.lit(as_of).cast("timestamp")))
    fresh = written(counts, AL.new_alerts(found, history, as_of), "alerts").select(*history.columns)
    fresh.withColumn("alert_day", F.to_date("timestamp")).write.mode("append").partitionBy(
        "alert_day").parquet(store.alerts)
    summary = AL.alert_summary(read_alerts(spark, store, since=since), as_of, SUMMARY_HOURS, S.KEYS)
    return fresh, summary


def read_alerts(
    spark: SparkSession, store: Store, n: int | None = None, since: datetime | None = None
) -> DataFrame:
    """The alert history; ``since`` prunes older days, ``n`` asks for the newest per city only."""
    if not table_exists(spark, store.alerts):
        return spark.createDataFrame([], HISTORY)
    history = spark.read.schema(HISTORY + ", alert_day date").parquet(store.alerts)
    if since is not None:
        history = history.filter(
            (F.col("alert_day") >= F.lit(since.date())) & (F.col("timestamp") >= F.lit(since)))
    history = history.drop("alert_day")
    return AL.retained(history, n, S.KEYS) if n is not None else history


def trim_alerts(spark: SparkSession, store: Store, n: int = AL.RETAINED) -> None:
    """Keep the newest ``n`` stored alerts of each city; a job of its own, so that no check sees fewer."""
    if table_exists(spark, store.alerts):
        kept = durable(read_alerts(spark, store, n), "retained")
        kept.withColumn("alert_day", F.to_date("timestamp")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("alert_day").parquet(store.alerts)


def snapshot(spark: SparkSession, store: Store, as_of: datetime, active_days: int | None = None) -> DataFrame:
    """Serving table: see ``state.snapshot_rows``."""
    current = durable(_active(state.read(spark, store), as_of, active_days), "current")
    predictions, models = forecast_latest(spark, store, current)
    counts = row_index(spark, store).groupBy(*S.KEYS).agg(F.sum("rows").alias("data_points"))
    return state.snapshot_rows(current, predictions, models, counts)


def explain(
    spark: SparkSession, store: Store, as_of: datetime, sample: int | None = None,
    horizons: Sequence[int] = S.HORIZONS,
) -> DataFrame | None:
    """Attribute the test forecasts of every registered model to its features.

    All test rows are explained; ``sample`` asks for so many, picked by hash. Importances, the ten strongest features and a summary of the run are stored.
    """
    models = registry.load_models(spark, store.models)
    if not models:
        return None
    training = FC.prepare(read_features(spark, store).filter(F.col(S.TARGET).isNotNull()), horizons=horizons)
    if training is None:
        return None
    carry = [*S.KEYS, S.TIME]
    test = training.rows.filter("split = 'test'")
    rows = durable(sample_rows(test, sample, carry) if sample is not None else test, "explained")
    parts = []
    linear = [f for f, _ in models if X.method(f) == "linear"]
    if linear:
        means = X.feature_means(X.feature_values(
            training.rows.filter("split = 'train'"), training.features, carry))
        long = X.feature_values(rows, training.features, carry)
        parts.append(X.linear_contributions(long, X.coefficient_table(spark, linear), means, carry))
    for algorithm in sorted({f.algorithm for f, _ in models if X.method(f) == "tree"}):
        forests = [(f, path) for f, path in models if f.algorithm == algorithm]
        boxes = {f.horizon: X.leaf_boxes(X.tree_nodes(spark, path)) for f, path in forests}
        parts.append(X.tree_contributions(rows, boxes, training.features, carry, algorithm).drop("base"))
    contributions = parts[0]
    for part in parts[1:]:
        contributions = contributions.unionByName(part)
    contributions = durable(contributions, "contributions")
    importance = durable(X.importance(contributions), "importance")
    run_id = registry.run_stamp(as_of)
    registry.write_section(importance, store.attributions, "importance", run_id)
    registry.write_section(attribution_summary(contributions, carry, as_of), store.attributions, "summary", run_id)
    registry.write_section(X.top_features(importance), store.attributions, "top_features", run_id)
    return importance
