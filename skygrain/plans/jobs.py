"""The jobs: first setup, update, alerts, interpretability."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from skygrain import schema as S
from skygrain.functions.index import with_aqi
from skygrain.operators import forecast as FC
from skygrain.operators import metrics as M
from skygrain.operators.alerts import RETAINED
from skygrain.plans import ingest, model_report, report, serving, training
from skygrain.plans.counts import Counts
from skygrain.plans.store import Store, day_range
from skygrain.session import tune
from skygrain.sources import payload, versioned
from skygrain.sources.feature_table import PRIMARY_KEY, random_split, training_frame


def _fetch(counts, spark, air_path, weather_path, locations, span, modified_after=None) -> DataFrame:
    return counts.durable(payload.observations(
        spark, air_path, weather_path, locations, *span, modified_after), "batch")


def setup(
    spark: SparkSession, store: Store, air_path: str, weather_path: str, locations: DataFrame,
    as_of: datetime, start: str | None = None, end: str | None = None,
) -> bool:
    """Landed files of a year, or of the given days, to report, features, models and alerts.

    False if there are no observations in the range.
    """
    tune(spark)
    counts = Counts("setup", as_of)
    span = day_range(start, end, as_of, 365)
    batch = _fetch(counts, spark, air_path, weather_path, locations, span)
    if batch.isEmpty():
        return False
    report.write_report(spark, store, with_aqi(batch), "initial_setup", as_of)
    ingest.write_observations(spark, store, batch, as_of, counts)
    ingest.build_features(spark, store, as_of, counts=counts)
    training.train(spark, store, as_of, counts=counts)
    model_report.write_metric_report(spark, store, as_of)
    serving.alert_check(spark, store, as_of, counts=counts)
    serving.explain(spark, store, as_of)
    counts.write(spark, store)
    return True


def update(
    spark: SparkSession, store: Store, air_path: str, weather_path: str, locations: DataFrame,
    as_of: datetime, start: str | None = None, end: str | None = None,
    modified_after: str | None = None,
) -> bool:
    """Readings of the last day, or of the given days; without any there is nothing to do.

    ``modified_after`` limits the landed files that are opened.
    """
    tune(spark)
    counts = Counts("update", as_of)
    span = day_range(start, end, as_of, 1)
    batch = _fetch(counts, spark, air_path, weather_path, locations, span, modified_after)
    if batch.isEmpty():
        return True
    report.write_report(spark, store, with_aqi(batch), "daily_update", as_of)
    ingest.write_observations(spark, store, batch, as_of, counts)
    ingest.update_features(spark, store, batch, as_of, counts=counts)
    training.train(spark, store, as_of, update_type="daily", counts=counts)
    model_report.write_metric_report(spark, store, as_of)
    serving.alert_check(spark, store, as_of, counts=counts)
    counts.write(spark, store)
    return True


def alerts(spark: SparkSession, store: Store, as_of: datetime):
    return serving.alert_check(tune(spark), store, as_of)


def interpretability(spark: SparkSession, store: Store, as_of: datetime):
    return serving.explain(tune(spark), store, as_of)


def retention(spark: SparkSession, store: Store, alerts_kept: int = RETAINED, stale_share: float = 0.2) -> dict[str, int]:
    """Keep the newest alerts of each city, compact the tables and delete the files that no read needs; to be run alone.

    Returns the number of buckets compacted per table.
    """
    tune(spark)
    serving.trim_alerts(spark, store, alerts_kept)
    done = {}
    for name, path, keys in (("observations", store.observations, PRIMARY_KEY), ("features", store.features, PRIMARY_KEY),
                             ("row_index", store.row_index, ingest.INDEX_KEY), ("state", store.state, S.KEYS)):
        if versioned.exists(spark, path):
            done[name] = versioned.compact(spark, path, keys, stale_share)
            versioned.vacuum(spark, path)
    return done


def single_horizon(spark: SparkSession, store: Store, algorithms=FC.ALGORITHMS) -> DataFrame | None:
    """Train the single-horizon forecaster on the stored features, all algorithms; its train and test metrics side by side."""
    tune(spark)
    rows, columns = training_frame(ingest.read_features(spark, store))
    if rows.limit(FC.LEAST_ROWS).count() < FC.LEAST_ROWS:
        return None
    _, metrics = FC.fit_single(rows, random_split(rows), columns, algorithms)
    return M.summary_by_model(metrics)
