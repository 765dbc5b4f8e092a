"""The data profile from stored parts: one state per month, merged when a report is wanted.

A state is sums: rows, values, powers of the values up to the fourth and products of pairs, all about one fixed centre per
column, with the extremes and the number of rows of every distinct value. Sums of months add up to those of
the whole table, so a report reads the states of old months and the rows of new ones only. The centre keeps the digits:
it is the mean of the first months and never changes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain.operators.ordered import GROUP_LIMIT
from skygrain.operators.profile import long_form, matrix_of, pair_correlations
from skygrain.sources.feature_table import table_exists

PERIOD = "event_month"
PAIR_SUMS = ["n", "sx", "sy", "sxy", "sxx", "syy"]
SHARES = {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.9, "p95": 0.95}


@dataclass(frozen=True)
class States:
    """``moments``: month, column, rows, count, s1 to s4, min, max. ``pairs``: month, i, j and sums. ``values``: month, column, value, n."""

    moments: DataFrame
    pairs: DataFrame
    values: DataFrame


def centres(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The mean of each column, 0 for one without values; one row to the driver."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return {c: 0.0 if row[c] is None else float(row[c]) for c in columns}


def states(df: DataFrame, columns: Sequence[str], centre: dict[str, float]) -> States:
    """The states of all months of ``df``, which has their names as ``event_month``.

    Missing values count as rows only. NaN is missing.
    """
    columns = list(columns)
    clean = df.select(PERIOD, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    rows = clean.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("rows"))
    at = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(centre[c]))])
    values = long_form(clean, columns, [PERIOD]).groupBy(PERIOD, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    # from the distinct values, which are fewer than the rows
    d = F.col("value") - at[F.col("column")]
    n = F.col("n")
    sums = values.groupBy(PERIOD, "column").agg(
        F.sum(n).alias("count"), *[F.sum(n * F.pow(d, F.lit(float(k)))).alias(f"s{k}") for k in (1, 2, 3, 4)], F.min("value").alias("min"), F.max("value").alias("max"))
    every = rows.withColumn("column", F.explode(F.array(*[F.lit(c) for c in columns])))
    moments = every.join(sums, [PERIOD, "column"], "left").select(
        PERIOD, "column", "rows", F.coalesce("count", F.lit(0)).alias("count"), *[F.coalesce(f"s{k}", F.lit(0.0)).alias(f"s{k}") for k in (1, 2, 3, 4)], "min", "max")
    return States(moments, _pairs(clean, columns, centre), values)


def _pairs(clean: DataFrame, columns: list[str], centre: dict[str, float]) -> DataFrame:
    """Sums over the rows that have both columns, per month and pair; a matrix product for each month of a batch."""
    shift = np.array([centre[c] for c in columns])

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, totals = len(columns), {}
        for batch in batches:
            for month, some in batch.groupby(PERIOD, dropna=False):
                x = some[columns].to_numpy(dtype=float) - shift
                here = np.isfinite(x)
                x, m = np.where(here, x, 0.0), here.astype(float)
                totals[month] = totals.get(month, np.zeros((4, p, p))) + np.stack([m.T @ m, x.T @ m, x.T @ x, (x * x).T @ m])
        i, j = np.triu_indices(len(columns))
        for month, (n, sx, sxy, sxx) in totals.items():
            yield pd.DataFrame({PERIOD: month, "i": i, "j": j, "n": n[i, j], "sx": sx[i, j], "sy": sx[j, i], "sxy": sxy[i, j], "sxx": sxx[i, j], "syy": sxx[j, i]})

    schema = f"{PERIOD} string, i int, j int, " + ", ".join(f"{s} double" for s in PAIR_SUMS)
    return clean.select(PERIOD, *columns).mapInPandas(products, schema).groupBy(PERIOD, "i", "j").agg(*[F.sum(s).alias(s) for s in PAIR_SUMS])


def write_states(found: States, path: str) -> None:
    """Store states; those of the same months are replaced, others stay."""
    for name in ("moments", "pairs", "values"):
        getattr(found, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(f"{path}/{name}")


def read_states(spark: SparkSession, path: str) -> States | None:
    if not table_exists(spark, f"{path}/moments"):
        return None
    return States(*[spark.read.parquet(f"{path}/{name}").withColumn(PERIOD, F.col(PERIOD).cast("string")) for name in ("moments", "pairs", "values")])


def distributions(found: States, centre: dict[str, float], limit: int = GROUP_LIMIT) -> DataFrame | None:
    """What ``profile.distributions`` gives for all rows of the states.

    None if a column has more distinct values than one task should hold: then the quantiles need the rows.
    """
    values = found.values.groupBy("column", "value").agg(F.sum("n").alias("n"))
    if values.groupBy("column").count().filter(F.col("count") > limit).limit(1).count():
        return None
    shares = F.array(*[F.lit(s) for s in SHARES.values()])
    quantiles = values.groupBy("column").agg(F.percentile("value", shares, F.col("n")).alias("q"))
    total = found.moments.groupBy("column").agg(
        F.sum("count").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in (1, 2, 3, 4)], F.min("min").alias("min"), F.max("max").alias("max"))
    at = F.create_map(*[x for c, v in centre.items() for x in (F.lit(c), F.lit(v))])
    n, flat = F.col("n"), F.col("min") == F.col("max")
    a, b, c, d = (F.col(f"s{k}") / n for k in (1, 2, 3, 4))
    m2, m3 = b - a * a, c - 3 * a * b + 2 * a * a * a
    m4 = d - 4 * a * c + 6 * a * a * b - 3 * a * a * a * a
    several = (n > 1) & ~flat
    out = total.filter(n > 0).join(quantiles, "column").select(
        "column", F.when(flat, F.col("min")).otherwise(at[F.col("column")] + a).alias("mean"),
        F.when(n > 1, F.when(flat, 0.0).otherwise(F.sqrt(m2 * n / (n - 1)))).alias("std"), "min", "max",
        F.when(several, m3 / F.pow(m2, F.lit(1.5))).when(n <= 1, 0.0).alias("skewness"), F.when(several, m4 / (m2 * m2) - 3).when(n <= 1, 0.0).alias("kurtosis"),
        *[F.col("q")[i].alias(name) for i, name in enumerate(SHARES)])
    return out.select("column", "mean", "median", "std", "min", "max", "skewness", "kurtosis", "p25", "p75", "p90", "p95")


def correlation_matrix(found: States, columns: Sequence[str]) -> DataFrame:
    """What ``profile.correlation_matrix`` gives for all rows of the states."""
    sums = found.pairs.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in PAIR_SUMS])
    return matrix_of(pair_correlations(sums, columns))


def missing_by_column(found: States) -> DataFrame:
    """Columns with missing values, their number and share, over all rows of the states."""
    total = found.moments.groupBy("column").agg(F.sum("rows").alias("r"), F.sum("count").alias("c"))
    return total.filter(F.col("r") > F.col("c")).select("column", (F.col("r") - F.col("c")).alias("missing_count"), ((F.col("r") - F.col("c")) / F.col("r") * 100).alias("percentage"))
