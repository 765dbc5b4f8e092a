"""Air quality index: unit conversion, banded sub-indices, overall value, category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bands as (concentration from, to, index from, to).
PM25 = [
    (0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.4, 301, 500),
]
PM10 = [
    (0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150),
    (255, 354, 151, 200), (355, 424, 201, 300), (425, 604, 301, 500),
]
O3 = [
    (0, 54, 0, 50), (55, 70, 51, 100), (71, 85, 101, 150),
    (86, 105, 151, 200), (106, 200, 201, 300),
]
NO2 = [
    (0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150),
    (361, 649, 151, 200), (650, 1249, 201, 300), (1250, 2049, 301, 500),
]
SO2 = [
    (0, 35, 0, 50), (36, 75, 51, 100), (76, 185, 101, 150),
    (186, 304, 151, 200), (305, 604, 201, 300), (605, 1004, 301, 500),
]
CO = [
    (0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
    (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300), (30.5, 50.4, 301, 500),
]
# Fixed value: the greatest index.
TOP_INDEX = 500

# Converted column -> (source column, divisor).
UNITS = {
    "ozone_ppb": ("ozone", 2.0),
    "nitrogen_dioxide_ppb": ("nitrogen_dioxide", 1.88),
    "sulphur_dioxide_ppb": ("sulphur_dioxide", 2.62),
    "carbon_monoxide_ppm": ("carbon_monoxide", 1145.0),
}

# Sub-index name -> (input column, bands, decimals of the band table).
SUB_INDICES = {
    "pm25_aqi": ("pm2_5", PM25, 1),
    "pm10_aqi": ("pm10", PM10, 0),
    "o3_aqi": ("ozone_ppb", O3, 0),
    "no2_aqi": ("nitrogen_dioxide_ppb", NO2, 0),
    "so2_aqi": ("sulphur_dioxide_ppb", SO2, 0),
    "co_aqi": ("carbon_monoxide_ppm", CO, 1),
}

# Fixed values: (index up to, category, level, colour, message).
CATEGORIES = [
    (50, "Good", 1, "#00E400",
     "Air quality is satisfactory, and air pollution poses little or no risk."),
    (100, "Moderate", 2, "#FFFF00",
     "Air quality is acceptable. However, there may be a risk for some people, "
     "particularly those who are unusually sensitive to air pollution."),
    (150, "Unhealthy for Sensitive Groups", 3, "#FF7E00",
     "Members of sensitive groups may experience health effects. "
     "The general public is less likely to be affected."),
    (200, "Unhealthy", 4, "#FF0000",
     "Some members of the general public may experience health effects; "
     "members of sensitive groups may experience more serious health effects."),
    (300, "Very Unhealthy", 5, "#8F3F97",
     "Health alert: The risk of health effects is increased for everyone."),
    (None, "Hazardous", 6, "#7E0023",
     "Health warning of emergency conditions: everyone is more likely to be affected."),
]
UNKNOWN = ("Unknown", 0, "#808080", "Insufficient data")

# Fixed values: (index up to, gauge colour); level names are those of CATEGORIES.
GAUGE = [
    (50, "green"), (100, "yellow"), (150, "orange"),
    (200, "red"), (300, "purple"), (None, "maroon"),
]


def sub_index(column: str, bands: list, decimals: int = 0, gap_policy: str = "cap") -> Column:
    """Piecewise-linear index of one pollutant.

    A missing or negative value has no index. Values beyond the last band get the
    top index, and so do values between two bands (the bands do not touch) under
    ``gap_policy="cap"``; ``"truncate"`` first cuts the value to the decimals of
    the band table, which leaves no gap.
    """
    c = f"cast(`{column}` as double)"
    if gap_policy == "truncate":
        # the epsilon keeps 0.3 * 10 = 2.9999... in its own step
        c = f"(floor({c} * {10 ** decimals}D + 1e-9D) / {10 ** decimals}D)"
    elif gap_policy != "cap":
        raise ValueError(f"unknown gap policy {gap_policy!r}")
    # one SQL text: as single Column calls the six ladders take seconds to build
    steps = " ".join(
        f"when {c} between {float(low)}D and {float(high)}D"
        f" then rint({(top - base) / (high - low)!r}D * ({c} - {float(low)}D) + {float(base)}D)"
        for low, high, base, top in bands)
    return F.expr(
        f"case when isnan({c}) or {c} is null or {c} < 0D then null {steps} else {TOP_INDEX}D end")


def overall(sub_indices: list[Column]) -> Column:
    """The largest available sub-index, or NULL if there is none."""
    if not sub_indices:
        return F.lit(None).cast("int")
    top = sub_indices[0] if len(sub_indices) == 1 else F.greatest(*sub_indices)
    return top.cast("int")


def with_units(df: DataFrame) -> DataFrame:
    """Add ppb / ppm columns for the gases that are present."""
    return df.withColumns({
        name: F.col(source) / F.lit(divisor)
        for name, (source, divisor) in UNITS.items() if source in df.columns
    })


def sub_indices(df: DataFrame, gap_policy: str = "cap") -> dict[str, Column]:
    """The sub-indices computable from the columns of ``df`` (after ``with_units``)."""
    return {
        name: sub_index(column, bands, decimals, gap_policy)
        for name, (column, bands, decimals) in SUB_INDICES.items()
        if column in df.columns
    }


def with_aqi(df: DataFrame, gap_policy: str = "cap") -> DataFrame:
    """Add converted units and ``aqi`` to an observation table."""
    df = with_units(df)
    return df.withColumn("aqi", overall(list(sub_indices(df, gap_policy).values())))


def _ladder(value: Column, steps: list, missing: Column, pick) -> Column:
    out = pick(steps[-1])
    for bound, *rest in reversed(steps[:-1]):
        out = F.when(value <= bound, pick((bound, *rest))).otherwise(out)
    return F.when(value.isNull(), missing).otherwise(out)


def category(aqi: Column) -> Column:
    """Struct of category, level, colour and health message."""

    def entry(name: str, level: int, color: str, message: str) -> Column:
        return F.struct(
            F.lit(name).alias("category"), F.lit(level).alias("level"),
            F.lit(color).alias("color"), F.lit(message).alias("message"))

    return _ladder(aqi, CATEGORIES, entry(*UNKNOWN), lambda step: entry(*step[1:]))


def gauge(aqi: Column) -> Column:
    """Struct of level name and gauge colour word."""
    steps = [(bound, name, color)
             for (bound, color), (_, name, *_) in zip(GAUGE, CATEGORIES)]

    def entry(name, color) -> Column:
        return F.struct(F.lit(name).cast("string").alias("level"),
                        F.lit(color).cast("string").alias("color"))

    return _ladder(aqi, steps, entry(None, None), lambda step: entry(*step[1:]))
