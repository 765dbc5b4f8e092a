"""Severity, wording and advice of an alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain.functions.numbers import one_decimal_text

# Fixed value: the index above which there is an alert.
ALERT_ABOVE = 50

# Fixed values: (severity, from index, threshold text, opening of the message).
SEVERITIES = [
    ("critical", 200, "Critical (200+)", "Very unhealthy air quality"),
    ("high", 150, "High (150+)", "Unhealthy air quality"),
    ("moderate", 100, "Moderate (100+)", "Unhealthy air quality for sensitive groups"),
    ("low", None, "Low (50+)", "Moderate air quality concern"),
]

# Advice per severity.
RECOMMENDATIONS = {
    "low": [
        "Consider reducing outdoor activities if you're sensitive to air pollution",
        "Monitor air quality updates",
    ],
    "moderate": [
        "Sensitive groups should reduce outdoor activities",
        "Consider wearing a mask if spending time outdoors",
        "Keep windows closed if possible",
    ],
    "high": [
        "Everyone should reduce outdoor activities",
        "Avoid strenuous outdoor exercise",
        "Keep windows and doors closed",
        "Use air purifiers if available",
    ],
    "critical": [
        "Avoid all outdoor activities",
        "Stay indoors with windows and doors closed",
        "Use air purifiers",
        "Consider relocating if possible",
    ],
}

# The reference table shown next to alerts.
THRESHOLD_ROWS = [
    ("Low", "51-100", "Moderate air quality concern"),
    ("Moderate", "101-150", "Unhealthy for sensitive groups"),
    ("High", "151-200", "Unhealthy air quality"),
    ("Critical", "200+", "Very unhealthy air quality"),
]


def _by_severity(value: Column, pick) -> Column:
    out = pick(SEVERITIES[-1])
    for row in reversed(SEVERITIES[:-1]):
        out = F.when(value >= row[1], pick(row)).otherwise(out)
    return out


def severity(aqi: Column) -> Column:
    return _by_severity(aqi, lambda row: F.lit(row[0]))


def threshold_text(aqi: Column) -> Column:
    return _by_severity(aqi, lambda row: F.lit(row[2]))


def message(aqi: Column, source: Column) -> Column:
    opening = _by_severity(aqi, lambda row: F.lit(row[3]))
    return F.concat(opening, F.lit(" detected: AQI "), one_decimal_text(aqi),
                    F.lit(" ("), source, F.lit(")"))


def recommendations(aqi: Column) -> Column:
    return _by_severity(
        aqi, lambda row: F.array(*[F.lit(text) for text in RECOMMENDATIONS[row[0]]]))


def thresholds(spark: SparkSession) -> DataFrame:
    """The four-row threshold table."""
    return spark.createDataFrame(
        [(name.lower(), name, span, text) for name, span, text in THRESHOLD_ROWS],
        "severity string, label string, aqi_range string, description string")
