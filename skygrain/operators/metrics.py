"""Forecast errors and roll-ups over metric records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions.calendar import minute_text
from skygrain.functions.numbers import clip, four_decimals, is_finite


def regression_metrics(
    df: DataFrame,
    by: Sequence[str],
    actual: str = "actual",
    predicted: str = "prediction",
    clipped: bool = True,
) -> DataFrame:
    """Mean squared error, mean absolute error and R² per group, in one pass.

    Predictions are bounded to 0..500 first unless ``clipped`` is off. Pairs with a
    missing or infinite side are left out. R² is -1 where it is undefined: constant
    target or no valid pair.
    """
    y = F.col(actual).cast("double")
    p = F.col(predicted).cast("double")
    p = clip(p) if clipped else p
    valid = is_finite(y) & is_finite(p)
    y, error = F.when(valid, y), F.when(valid, p - y)
    sums = df.groupBy(*by).agg(
        F.count(y).alias("n"), F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("_var"), F.min(y).alias("_min"), F.max(y).alias("_max"))
    r2 = F.when(F.col("_min") < F.col("_max"),
                F.lit(1.0) - F.col("mse") / F.nullif(F.col("_var"), F.lit(0.0)))
    return sums.select(*by, "n", "mse", "mae", F.coalesce(r2, F.lit(-1.0)).alias("r2"))


def metric_records(
    metrics: DataFrame, training_timestamp: Column, model_path: Column,
    version: str = "1.0", update_type: str | None = None,
) -> DataFrame:
    """Metrics per algorithm and horizon in the stored record shape."""
    return metrics.select(
        F.concat(F.lit("multi_output_"), F.col("algorithm")).alias("model_name"),
        F.col("horizon").cast("int").alias("horizon"), "algorithm",
        F.struct("mse", "mae", "r2").alias("metrics"),
        training_timestamp.cast("string").alias("training_timestamp"),
        model_path.alias("model_path"), F.lit(version).alias("version"),
        F.lit(update_type).cast("string").alias("update_type"))


def flat_records(records: DataFrame) -> DataFrame:
    """One flat row per record, with the defaults for absent fields."""
    return records.select(
        "model_name", F.coalesce("algorithm", F.lit("unknown")).alias("algorithm"), "horizon",
        F.coalesce("training_timestamp", F.lit("unknown")).alias("training_timestamp"),
        F.col("metrics.mse").alias("mse"), F.col("metrics.mae").alias("mae"),
        F.col("metrics.r2").alias("r2"), F.coalesce("version", F.lit("1.0")).alias("version"))


def best_models(flat: DataFrame) -> DataFrame:
    """The model with the least error and the one with the greatest R²; ties by name."""
    def best(metric: str, order: Column) -> Column:
        # a record without the metric never wins
        least_first = F.when(F.col(metric).isNotNull(), F.struct(order.alias("o"), "model_name"))
        return F.min_by(F.struct("model_name", metric), least_first).alias(f"_{metric}")

    row = flat.agg(F.count(F.lit(1)).alias("total_models"),
                   best("mae", F.col("mae")), best("r2", -F.col("r2")))
    return row.select(
        "total_models", F.col("_mae.model_name").alias("best_mae_model"),
        F.col("_mae.mae").alias("best_mae"), F.col("_r2.model_name").alias("best_r2_model"),
        F.col("_r2.r2").alias("best_r2"))


def model_ranking(flat: DataFrame) -> DataFrame:
    """All models by R², missing metrics counting as 0, rounded to four decimals."""
    ranked = flat.withColumns({
        "mae": F.coalesce("mae", F.lit(0.0)), "r2": F.coalesce("r2", F.lit(0.0))})
    return ranked.orderBy(F.desc("r2"), "model_name").select(
        "model_name", "algorithm", "horizon", four_decimals(F.col("r2")).alias("r2"),
        four_decimals(F.col("mae")).alias("mae"), "training_timestamp", "version")


def comparison_table(ranking: DataFrame) -> DataFrame:
    """The ranking under display names, with the time cut to the minute."""
    return ranking.select(
        F.col("model_name").alias("Model"), F.col("algorithm").alias("Algorithm"),
        F.col("horizon").alias("Horizon"), F.col("r2").alias("R² Score"), F.col("mae").alias("MAE"),
        minute_text(F.try_to_timestamp("training_timestamp")).alias("Last Trained"))


def horizon_rollup(flat: DataFrame) -> DataFrame:
    """Best and mean errors per horizon; a missing metric is 0 in means, never best."""
    zero = {m: F.coalesce(F.col(m), F.lit(0.0)) for m in ("mae", "r2")}
    # as many entries as there are models of one horizon
    models = F.sort_array(F.collect_list(F.struct(
        "model_name", "algorithm", zero["mae"].alias("mae"), zero["r2"].alias("r2"))))
    return flat.filter(F.col("horizon").isNotNull()).groupBy("horizon").agg(
        F.min("mae").alias("best_mae"), F.max("r2").alias("best_r2"),
        F.avg(zero["mae"]).alias("avg_mae"), F.avg(zero["r2"]).alias("avg_r2"),
        F.count(F.lit(1)).alias("model_count"), models.alias("models"))


def latest_per_algorithm(flat: DataFrame) -> DataFrame:
    """The most recently trained record of each algorithm; ties by name."""
    newest_first = Window.partitionBy("algorithm").orderBy(
        F.desc("training_timestamp"), "model_name", "horizon")
    return flat.withColumn("_rank", F.row_number().over(newest_first)).filter(
        F.col("_rank") == 1).drop("_rank")


def summary_by_model(metrics: DataFrame) -> DataFrame:
    """Train and test metrics of each algorithm and horizon side by side."""
    def pick(split: str, metric: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{split}_{metric}")

    return metrics.groupBy("algorithm", "horizon").agg(
        *[pick(s, m) for s in ("train", "test") for m in ("n", "mse", "mae", "r2")])


def representative(metrics: DataFrame, horizon: int = S.TARGET_HOURS) -> DataFrame:
    """Per algorithm the metrics of one horizon, or of its first if that is absent."""
    row = F.struct("horizon", "mse", "mae", "r2")
    wanted = F.max(F.when(F.col("horizon") == horizon, row))
    return metrics.groupBy("algorithm").agg(
        F.coalesce(wanted, F.min_by(row, "horizon")).alias("m")).select("algorithm", "m.*")
