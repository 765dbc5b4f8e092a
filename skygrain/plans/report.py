"""The data profile as a stored report, one table per section."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators import profile as P
from skygrain.operators import series as T
from skygrain.operators.ordered import GROUP_LIMIT
from skygrain.plans.store import Store
from skygrain.session import durable
from skygrain.sources.registry import read_section, run_stamp, write_section


def time_series_section(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = S.KEYS, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Daily mean, deviation, trend, weekly pattern and outliers per key and column."""
    daily = durable(T.daily_means(df, columns, keys), "daily")
    on = [*keys, "column"]
    counts = P.outlier_counts(df, columns, keys, limit).select(*on, "outliers_count")
    return T.daily_trend(daily, keys).join(T.seasonality(daily, keys), on).join(counts, on)


def report_sections(
    df: DataFrame, columns: Sequence[str] | None = None, target: str = "aqi", limit: int = GROUP_LIMIT
) -> dict[str, DataFrame]:
    """All sections over ``df``; ``columns`` are the time-series columns."""
    numeric = S.numeric_columns(df.schema)
    series = [c for c in (columns or [target, *S.POLLUTANTS]) if c in df.columns]
    pairs = P.correlation_pairs(df, numeric)
    sections = {
        "period": P.analysis_period(df),
        "overview": P.overview(df),
        "basic_stats": P.describe(df, numeric, limit),
        "distributions": P.distributions(df, numeric, limit),
        "time_series": time_series_section(df, series, limit=limit),
        "correlation_matrix": P.correlation_matrix(df, numeric),
        "strong_correlations": P.strong_correlations(pairs),
        "missing_by_column": P.missing_by_column(df),
        "missing_total": P.missing_total(df),
        "histogram": P.histogram(df, numeric),
    }
    if target in numeric:
        sections["target_correlations"] = P.target_correlations(df, numeric, target)
    return sections


def write_report(
    spark: SparkSession, store: Store, df: DataFrame, source: str, as_of: datetime,
    limit: int = GROUP_LIMIT,
) -> str | None:
    """Profile ``df`` and store the report; None if there are no rows."""
    if df.isEmpty():
        return None
    data = durable(df, "report")
    run_id = run_stamp(as_of)
    for name, section in report_sections(data, limit=limit).items():
        write_section(section.withColumn("data_source", F.lit(source)), store.reports, name, run_id)
    return run_id


def latest_report(spark: SparkSession, store: Store, section: str) -> DataFrame | None:
    return read_section(spark, store.reports, section)
