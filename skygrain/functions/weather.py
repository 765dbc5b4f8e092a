"""Derived readings of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wind_chill(temperature: Column, wind: Column) -> Column:
    """Wind-chill formula without a validity range; NULL for a negative wind speed."""
    # fixed values: the factors of the formula
    gust = F.when(wind >= 0, F.pow(wind, F.lit(0.16)))
    return (F.lit(13.12) + F.lit(0.6215) * temperature
            - F.lit(11.37) * gust + F.lit(0.3965) * temperature * gust)


def derived_columns(df: DataFrame) -> dict[str, Column]:
    """The derived readings whose inputs ``df`` has."""
    have = set(df.columns)
    out: dict[str, Column] = {}
    if {"temperature_2m", "relative_humidity_2m"} <= have:
        out["temp_humidity_interaction"] = (
            F.col("temperature_2m") * F.col("relative_humidity_2m"))
    if {"temperature_2m", "wind_speed_10m"} <= have:
        out["wind_chill"] = wind_chill(F.col("temperature_2m"), F.col("wind_speed_10m"))
    if {"pm2_5", "pm10"} <= have:
        out["pm_ratio"] = F.col("pm2_5") / F.nullif(F.col("pm10") + F.lit(1e-6), F.lit(0.0))
        out["pm_combined"] = F.col("pm2_5") + F.col("pm10")
    return out
