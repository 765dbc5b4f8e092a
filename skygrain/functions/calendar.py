"""Calendar features and date handling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Hours of dense traffic.
RUSH_HOURS = (7, 8, 17, 18)


def calendar_columns(time: Column) -> dict[str, Column]:
    """Hour, weekday (Monday 0), month, weekend, rush hour, season, and their cycles."""
    hour, weekday, month = F.hour(time), F.weekday(time), F.month(time)

    def cycle(function, value: Column, period: int) -> Column:
        return function(F.lit(2 * math.pi) * value / F.lit(float(period)))

    return {
        "hour": hour,
        "day_of_week": weekday,
        "month": month,
        "is_weekend": weekday.isin(5, 6).cast("int"),
        "is_rush_hour": hour.isin(*RUSH_HOURS).cast("int"),
        # December to February 0, then one step per three months
        "season": F.floor((month % 12) / 3).cast("int"),
        "hour_sin": cycle(F.sin, hour, 24),
        "hour_cos": cycle(F.cos, hour, 24),
        "dow_sin": cycle(F.sin, weekday, 7),
        "dow_cos": cycle(F.cos, weekday, 7),
        "month_sin": cycle(F.sin, month, 12),
        "month_cos": cycle(F.cos, month, 12),
    }


def with_calendar(df: DataFrame, time: str = "timestamp", zone: str | None = None) -> DataFrame:
    """Add the calendar columns, in UTC or in a local time zone."""
    moment = F.col(time)
    if zone is not None:
        moment = F.from_utc_timestamp(moment, zone)
    return df.withColumns(calendar_columns(moment))


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date; anything else is NULL."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def in_days(df: DataFrame, start: str | None, end: str | None, time: str = "timestamp") -> DataFrame:
    """Rows from ``start`` to ``end``, both days included; either may be open.

    The bounds are literals, so the filter reaches a Parquet scan.
    """
    if start:
        df = df.filter(F.col(time) >= F.lit(start).cast("date").cast("timestamp"))
    if end:
        df = df.filter(F.col(time) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    return df


def minute_text(time: Column) -> Column:
    return F.date_format(time.cast("timestamp"), "yyyy-MM-dd HH:mm")
