"""Numeric helpers that keep missing-value rules the same everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean "missing"; keep only NULL."""
    floating = (T.DoubleType, T.FloatType)
    return df.select([
        F.nanvl(F.col(f.name), F.lit(None)).cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, floating) else F.col(f.name)
        for f in df.schema.fields
    ])


def one_decimal(value: Column) -> Column:
    """Round half-even to one decimal."""
    return F.bround(value.cast("double"), 1)


def one_decimal_text(value: Column) -> Column:
    return one_decimal(value).cast("string")


def four_decimals(value: Column) -> Column:
    """Coerce to a number, unparsable text becoming NULL, and round half-even."""
    return F.bround(value.try_cast("double"), 4)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both sides are present; NULL if one is constant.

    ``corr`` itself divides by zero on a constant column.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.covar_pop(px, py) / F.nullif(spread, F.lit(0.0))


def clip(value: Column, low: float = 0.0, high: float = 500.0) -> Column:
    """Bound ``value``; a missing value stays missing."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def is_finite(value: Column) -> Column:
    v = value.cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
