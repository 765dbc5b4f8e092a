"""Training on the stored features, with models and metrics registered."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators import forecast as FC
from skygrain.operators import metrics as M
from skygrain.operators.series import newest
from skygrain.plans.counts import Counts, written
from skygrain.plans.ingest import read_features
from skygrain.plans.store import Store
from skygrain.sources import registry


def train(
    spark: SparkSession, store: Store, as_of: datetime, update_type: str | None = None,
    algorithms: Sequence[str] = FC.ALGORITHMS, horizons: Sequence[int] = S.HORIZONS,
    limit: int | None = None, embargo: int = 0, counts: Counts | None = None,
) -> DataFrame | None:
    """Fit all models, store them with their test metrics, and return the metrics.

    ``limit`` keeps the newest rows only; by default all are used. Fewer than 100
    usable rows train nothing.
    """
    rows = newest(read_features(spark, store), limit, (), (S.TIME, "city")).filter(F.col(S.TARGET).isNotNull())
    training = FC.prepare(rows, horizons=horizons, embargo=embargo)
    if training is None:
        return None
    fitted = FC.fit(training, algorithms)
    metrics = written(counts, FC.evaluate(fitted, training), "metrics")
    if counts is not None:
        counts.note("models", len(fitted), len(training.features))
    test = metrics.filter("split = 'test'")
    version = registry.run_stamp(as_of)
    by_model = {(r.algorithm, r.horizon): (r.mse, r.mae, r.r2) for r in test.collect()}  # one per model
    registry.save_models(
        spark, store.models, fitted, version, by_model, "Air quality index forecast, all horizons")
    path = F.concat_ws("/", F.lit(f"{store.models}/models"), F.concat(
        F.lit(f"{registry.MODEL_BASE}_multi_output_"), F.col("algorithm")), F.lit(version))
    records = M.metric_records(test, F.lit(as_of.isoformat()), path, update_type=update_type)
    registry.write_metrics(records, store.metrics)
    return metrics
