"""Column names, schemas and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The measured variables, in payload order.
POLLUTANTS = [
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
    "sulphur_dioxide", "ozone", "dust", "uv_index",
]
WEATHER = [
    "temperature_2m", "relative_humidity_2m", "pressure_msl",
    "wind_speed_10m", "wind_direction_10m", "precipitation", "cloud_cover",
]

# Which columns get lags and rolling statistics, and how far.
LAG_COLUMNS = [
    "pm2_5", "pm10", "ozone", "nitrogen_dioxide", "sulphur_dioxide",
    "carbon_monoxide", "temperature_2m", "relative_humidity_2m",
    "wind_speed_10m", "wind_direction_10m", "aqi",
]
LAG_HOURS = [1, 6]
ROLLING_COLUMNS = [
    "pm2_5", "pm10", "ozone", "nitrogen_dioxide", "temperature_2m",
    "wind_speed_10m", "relative_humidity_2m", "pressure_msl", "aqi",
]
ROLLING_WINDOWS = [12, 24, 48]
TARGET_HOURS = 6
TARGET = "aqi_6h_ahead"
HORIZONS = [1, 6, 12, 24, 48, 72]
TRAIN_SHARE = 0.8

KEYS = ("city",)
TIME = "timestamp"

OBSERVATIONS = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in POLLUTANTS]
    + [T.StructField(TIME, T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in WEATHER]
    + [
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

PREDICTIONS = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("as_of", T.TimestampType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
])

METRIC_RECORD = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("metrics", T.StructType([
        T.StructField("mse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ])),
    T.StructField("training_timestamp", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("update_type", T.StringType()),
])


def payload_schema(variables: list[str]) -> T.StructType:
    """The landed JSON object: parallel arrays below ``hourly``."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType([
        T.StructField("city", T.StringType()),
        T.StructField("hourly", T.StructType(arrays)),
    ])


def lag_name(column: str, rows: int) -> str:
    return f"{column}_lag_{rows}h"


def rolling_name(column: str, stat: str, rows: int) -> str:
    return f"{column}_rolling_{stat}_{rows}h"


def horizon_name(rows: int) -> str:
    return f"aqi_h{rows}"


def numeric_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
