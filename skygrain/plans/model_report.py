"""What the stored metrics and models say: rankings, roll-ups, and explanations of current forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators import attribution as X
from skygrain.operators import forecast as FC
from skygrain.operators import metrics as M
from skygrain.plans import state
from skygrain.plans.ingest import read_features
from skygrain.plans.store import Store
from skygrain.session import durable
from skygrain.sources import registry
from skygrain.sources.feature_table import table_exists


def newest_records(records: DataFrame) -> DataFrame:
    """One record per model and horizon, the one trained last: earlier runs are history."""
    return records.groupBy("model_name", "horizon").agg(
        F.max_by(F.struct(*[c for c in records.columns if c not in ("model_name", "horizon")]), F.coalesce("training_timestamp", F.lit(""))).alias("r")
    ).select("model_name", "horizon", "r.*").select(*records.columns)


def metric_sections(records: DataFrame, horizon: int = S.TARGET_HOURS) -> dict[str, DataFrame]:
    """All views of the newest metrics: best models, ranking, comparison, per horizon, per algorithm, the representative ones."""
    flat = M.flat_records(newest_records(records))
    ranking = M.model_ranking(flat)
    table = M.comparison_table(ranking)
    return {
        "best_model": M.best_models(flat), "ranking": ranking,
        # plain names, as columns of a stored table
        "comparison": table.toDF("model", "algorithm", "horizon", "r2", "mae", "last_trained"),
        "horizons": M.horizon_rollup(flat), "latest": M.latest_per_algorithm(flat),
        "representative": M.representative(flat.filter(F.col("horizon").isNotNull()), horizon)}


def write_metric_report(spark: SparkSession, store: Store, as_of: datetime) -> str | None:
    """Store all sections of the newest metrics; None if nothing was trained yet."""
    if not table_exists(spark, f"{store.models}/registry"):
        return None
    records = durable(registry.read_metrics(spark, store.metrics), "records")
    run_id = registry.run_stamp(as_of)
    for name, section in metric_sections(records).items():
        registry.write_section(section, f"{store.reports}/metrics", name, run_id)
    return run_id


def read_metric_report(spark: SparkSession, store: Store, section: str) -> DataFrame | None:
    return registry.read_section(spark, f"{store.reports}/metrics", section)


def attribution_summary(contributions: DataFrame, carry: Sequence[str], as_of: datetime) -> DataFrame:
    """Per model and horizon: rows explained, features, and when."""
    return contributions.groupBy("model", "horizon").agg(
        F.count_distinct(F.struct(*carry)).alias("test_samples_analyzed"), F.count_distinct("feature").alias("total_features")).withColumn(
        "analysis_timestamp", F.lit(as_of).cast("timestamp"))


def explain_latest(spark: SparkSession, store: Store, cities: Sequence[str] | None = None) -> DataFrame | None:
    """Why each model forecasts what it does from a city's newest row: prediction, contribution and value of every feature.

    One row per city, model and horizon; cities whose newest row lacks a sensor have none. The means that linear models are compared with are
    those of the stored complete rows with a known target.
    """
    models = registry.load_models(spark, store.models)
    if not models:
        return None
    rows = state.model_inputs(state.read(spark, store))
    rows = rows if cities is None else rows.filter(F.col("city").isin(list(cities)))
    names = list(max((f.features for f, _ in models), key=len))
    carry = [*S.KEYS, S.TIME]
    rows = durable(FC.assemble(rows, names).select(*carry, FC.VECTOR), "latest")
    predictions = FC.predict([f for f, _ in models], rows, names, carry)
    parts = []
    linear = [f for f, _ in models if X.method(f) == "linear"]
    if linear:
        known = read_features(spark, store).filter(F.col(S.TARGET).isNotNull())
        means = known.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).unpivot([], names, "feature", "mean")
        parts.append(X.linear_contributions(X.feature_values(rows, names, carry), X.coefficient_table(spark, linear), means, carry))
    for algorithm in sorted({f.algorithm for f, _ in models if X.method(f) == "tree"}):
        boxes = {f.horizon: X.leaf_boxes(X.tree_nodes(spark, path)) for f, path in models if f.algorithm == algorithm}
        parts.append(X.tree_contributions(rows, boxes, names, carry, algorithm).drop("base"))
    return X.explanation(reduce(DataFrame.unionByName, parts), predictions, carry)
