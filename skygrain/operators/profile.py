"""Data profile: overview, distributions, outliers, correlations, missing values."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain import schema as S
from skygrain.functions.numbers import pearson
from skygrain.operators.ordered import GROUP_LIMIT
from skygrain.operators.quantiles import column_quantiles
from skygrain.session import durable, small_side


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, column, value)`` with missing values, NaN among them, left out."""
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keys), list(columns), "column", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value"))


def analysis_period(df: DataFrame, time: str = S.TIME) -> DataFrame:
    moment = F.col(time).cast("timestamp")
    return df.agg(F.min(moment).alias("start"), F.max(moment).alias("end")).withColumn(
        "duration_days",
        F.floor((F.unix_micros("end") - F.unix_micros("start")) / F.lit(86_400_000_000)).cast("int"))


def overview(df: DataFrame) -> DataFrame:
    """One row per column: position, type, role and the table's row count."""

    def role(kind: T.DataType) -> str:
        if isinstance(kind, T.NumericType):
            return "numeric"
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "datetime"
        return "categorical" if isinstance(kind, T.StringType) else "other"

    names = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), role(f.dataType))
         for i, f in enumerate(df.schema.fields)],
        "position int, column string, dtype string, role string")
    return names.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("row_count"))))


def _statistics(
    df: DataFrame, columns: Sequence[str], shares: dict[str, float], limit: int
) -> DataFrame:
    """Count, moments and quantiles per column; all in one pass if the table is small."""
    long, rows = long_form(df, columns), df.count()
    v = F.col("value")
    moments = [
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis")]
    wanted = list(shares.values())
    if rows <= limit:
        together = F.percentile(v, F.array(*[F.lit(s) for s in wanted])).alias("quantiles")
        out = long.groupBy("column").agg(*moments, together)
    else:
        apart = column_quantiles(df, columns, wanted, (), limit, rows)
        out = long.groupBy("column").agg(*moments).join(F.broadcast(apart), "column")  # a row per column
    several = F.col("count") > 1
    return out.withColumns({
        "skewness": F.when(several, F.col("skewness")).otherwise(0.0),
        "kurtosis": F.when(several, F.col("kurtosis")).otherwise(0.0),
        **{name: F.col("quantiles")[i] for i, name in enumerate(shares)}})


def describe(df: DataFrame, columns: Sequence[str], limit: int = GROUP_LIMIT) -> DataFrame:
    """Count, mean, std, min, quartiles and max per column."""
    stats = _statistics(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, limit)
    return stats.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def distributions(df: DataFrame, columns: Sequence[str], limit: int = GROUP_LIMIT) -> DataFrame:
    """Mean, median, std, min, max, skewness, excess kurtosis and upper percentiles."""
    stats = _statistics(
        df, columns, {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.9, "p95": 0.95}, limit)
    return stats.select("column", "mean", "median", "std", "min", "max", "skewness", "kurtosis",
                        "p25", "p75", "p90", "p95")


def outlier_bounds(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), limit: int = GROUP_LIMIT
) -> DataFrame:
    """Quartiles and the fences 1.5 interquartile ranges beyond them."""
    q = column_quantiles(df, columns, [0.25, 0.75], keys, limit, df.count())
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    return q.select(*keys, "column", q1.alias("q1"), q3.alias("q3")).withColumns({
        "lower": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
        "upper": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})


def _bounds_side(bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Without keys there is one row per column name; with keys, count first."""
    return small_side(durable(bounds, "bounds")) if keys else F.broadcast(bounds)


def outliers(
    df: DataFrame,
    columns: Sequence[str],
    carry: Sequence[str],
    keys: Sequence[str] = (),
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Values outside the fences, with the ``carry`` columns of their rows."""
    bounds = outlier_bounds(df, columns, keys, limit)
    long = long_form(df, columns, list(dict.fromkeys([*keys, *carry])))
    return long.join(_bounds_side(bounds, keys), [*keys, "column"]).filter(
        (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    ).select(*dict.fromkeys([*keys, *carry]), "column", "value", "lower", "upper")


def outlier_counts(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), limit: int = GROUP_LIMIT
) -> DataFrame:
    """Number of values outside the fences per column, zero included."""
    bounds = outlier_bounds(df, columns, keys, limit)
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return (long_form(df, columns, keys).join(_bounds_side(bounds, keys), [*keys, "column"])
            .groupBy(*keys, "column")
            .agg(F.first("q1").alias("q1"), F.first("q3").alias("q3"),
                 F.first("lower").alias("lower"), F.first("upper").alias("upper"),
                 F.sum(outside.cast("long")).alias("outliers_count")))


def _pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums over the rows where both columns are present, for every ``i <= j``.

    All pairs as SQL aggregates are p * p expressions per row. A matrix product per
    Arrow batch gives the same sums; each task hands on p * (p + 1) / 2 rows. Values
    are shifted by the column mean first, so the sums keep their digits.
    """
    columns = list(columns)
    centre = df.agg(*[
        F.when(F.min(F.col(c).cast("double")) == F.max(F.col(c).cast("double")),
               F.min(F.col(c).cast("double"))).otherwise(F.avg(F.col(c).cast("double"))).alias(c)
        for c in columns]).first()  # one row, one number per column
    shift = np.array([0.0 if v is None else v for v in centre], dtype=float)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(shift)
        total = np.zeros((4, p, p))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            here = np.isfinite(x)
            x = np.where(here, x, 0.0)
            m = here.astype(float)
            total += np.stack([m.T @ m, x.T @ m, x.T @ x, (x * x).T @ m])
        i, j = np.triu_indices(p)
        n, sx, sxy, sxx = total
        yield pd.DataFrame({
            "i": i, "j": j, "n": n[i, j], "sx": sx[i, j], "sy": sx[j, i],
            "sxy": sxy[i, j], "sxx": sxx[i, j], "syy": sxx[j, i]})

    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sums = ["n", "sx", "sy", "sxy", "sxx", "syy"]
    schema = "i int, j int, " + ", ".join(f"{s} double" for s in sums)
    return doubles.mapInPandas(products, schema).groupBy("i", "j").agg(
        *[F.sum(s).alias(s) for s in sums])


def pair_correlations(sums: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``var1, var2, correlation`` from the sums of every pair ``i <= j``."""
    names = F.array(*[F.lit(c) for c in columns])
    n = F.nullif(F.col("n"), F.lit(0.0))
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    # what is left of a constant column is rounding noise
    varies = (vx > F.col("sxx") * 1e-13) & (vy > F.col("syy") * 1e-13)
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(vx) / F.sqrt(vy)))
    return sums.select(
        names[F.col("i")].alias("var1"), names[F.col("j")].alias("var2"),
        F.when(varies, r).alias("correlation"))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, upper triangle.

    A pair uses the rows where both values are present; a constant column
    correlates with nothing (NULL).
    """
    return pair_correlations(_pair_sums(df, columns), columns).filter(F.col("var1") != F.col("var2"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both triangles and the diagonal."""
    return matrix_of(pair_correlations(_pair_sums(df, columns), columns))


def matrix_of(half: DataFrame) -> DataFrame:
    both = F.array(F.struct("var1", "var2"), F.struct(F.col("var2").alias("var1"), F.col("var1").alias("var2")))
    return half.select(F.explode(F.array_distinct(both)).alias("v"), "correlation").select(
        "v.var1", "v.var2", "correlation")


def strong_correlations(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    return pairs.filter(F.abs("correlation") > threshold).select("var1", "var2", "correlation")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str = "aqi") -> DataFrame:
    """Correlation of each other column with the target, in one pass."""
    others = [c for c in columns if c != target]
    row = df.agg(*[pearson(F.col(c), F.col(target)).alias(c) for c in others])
    return row.unpivot([], others, "variable", "correlation")


def top_correlations(correlations: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` strongest; equal to nine decimals counts as a tie, decided by name."""
    strength = F.round(F.abs("correlation"), 9)
    return correlations.orderBy(F.desc_nulls_last(strength), "variable").limit(n)


def missing_by_column(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing values per column, count and share, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(c) for c in df.columns])
    long = counts.unpivot(["_rows"], df.columns, "column", "missing_count")
    out = long.select("column", "missing_count",
                      (F.col("missing_count") / F.col("_rows") * 100).alias("percentage"), "_rows")
    return (out.filter(F.col("missing_count") > 0) if only_missing else out).drop("_rows")


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells of the whole table, count and share."""
    cells = F.col("_rows") * len(df.columns)
    missing = sum((F.count(F.lit(1)) - F.count(F.col(f"`{c}`")) for c in df.columns), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("_rows"), missing.alias("total_missing")).select(
        "total_missing", (F.col("total_missing") / cells * 100).alias("missing_percentage"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal bins per column, from its minimum to its maximum.

    The last bin is closed on both sides. A constant column has all values in the
    bin holding the middle of a unit-wide range around it.
    """
    long = long_form(df, columns)
    ends = long.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    ends = ends.select(
        "column", F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("low"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("high"))
    number = F.least(F.width_bucket("value", "low", "high", F.lit(bins)), F.lit(bins)).cast("int")
    width = (F.col("high") - F.col("low")) / bins
    return (long.join(F.broadcast(ends), "column")  # one row per column name
            .groupBy("column", "low", "high", number.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("column", "bin", (F.col("low") + (F.col("bin") - 1) * width).alias("bin_from"),
                    (F.col("low") + F.col("bin") * width).alias("bin_to"), "n"))
