"""Views that give the given tables the shape of air-quality observations.

Measures are multiples of a power of two, so sums are exact in any order and an
average is the same double on both sides of a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions.index import with_aqi
from skygrain.session import tune

ORDER = ["timestamp", "event_id"]
MEASURES = S.POLLUTANTS + S.WEATHER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event, spread over four cities."""
    events = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    x = F.floor(F.col("value") * 16) / F.lit(16.0)
    e = events.select("*", k.alias("k"), x.alias("x"))
    return e.select(
        F.concat(F.lit("C"), (F.col("user_id") % 4).cast("string")).alias("city"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_id", "event_type",
        F.col("x").alias("pm10"),
        (F.col("x") / 2).alias("pm2_5"),
        (F.col("x") * 40.0).alias("carbon_monoxide"),
        (F.col("x") * 1.5).alias("nitrogen_dioxide"),
        (F.col("k") * 3.0).alias("sulphur_dioxide"),
        (F.col("k") * 2.25).alias("ozone"),
        (F.col("x") / 8).alias("dust"),
        (F.col("k") / 16.0).alias("uv_index"),
        (F.col("k") * 0.375 - 10.0).alias("temperature_2m"),
        (F.col("k") * 0.75 + 20.0).alias("relative_humidity_2m"),
        (F.col("k") * 0.625 + 980.0).alias("pressure_msl"),
        (F.col("k") / 4.0).alias("wind_speed_10m"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("wind_direction_10m"),
        F.when(F.col("k") < 20, F.col("k") / 8.0).otherwise(0.0).alias("precipitation"),
        F.col("k").cast("double").alias("cloud_cover"),
        F.lit(51.5).alias("latitude"), F.lit(-0.125).alias("longitude"),
    )


def obs_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_aqi(obs(spark, sf_dir))


def obs_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with some particle and ozone readings missing."""
    df = obs(spark, sf_dir)
    return df.withColumns({
        "pm2_5": F.when(F.col("cloud_cover") != 13, F.col("pm2_5")),
        "ozone": F.when(F.col("cloud_cover") != 17, F.col("ozone"))})


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last reading of every city and hour, some values missing; hours without a reading are missing as rows."""
    df = obs_null(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    last = df.groupBy("city", "timestamp").agg(F.max_by(F.struct("event_id", *MEASURES, "latitude", "longitude"), "event_id").alias("r"))
    return last.select("city", "timestamp", "r.*")


def air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).select("city", "timestamp", "event_id", *S.POLLUTANTS)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather lacks the hours of error events, so an inner join drops rows."""
    return obs(spark, sf_dir).filter("event_type <> 'error'").select(
        "city", "timestamp", "event_id", *S.WEATHER)


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long series of readings: line items by ship date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"))


# The same views in SQL, to be prefixed to every comparison query.
OBS_SQL = """
e as (
  select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
         floor(value * 16) / 16e0 as x
  from events),
obs as (
  select concat('C', cast(user_id % 4 as varchar)) as city, cast(ts as timestamp) as timestamp,
    event_id, event_type, x as pm10, x / 2 as pm2_5, x * 40e0 as carbon_monoxide,
    x * 1.5e0 as nitrogen_dioxide, k * 3e0 as sulphur_dioxide, k * 2.25e0 as ozone,
    x / 8 as dust, k / 16e0 as uv_index, k * 0.375e0 - 10e0 as temperature_2m,
    k * 0.75e0 + 20e0 as relative_humidity_2m, k * 0.625e0 + 980e0 as pressure_msl,
    k / 4e0 as wind_speed_10m, cast((event_id * 37) % 360 as double) as wind_direction_10m,
    case when k < 20 then k / 8e0 else 0e0 end as precipitation,
    cast(k as double) as cloud_cover, 51.5e0 as latitude, -0.125e0 as longitude
  from e),
obs_null as (
  select * replace (case when cloud_cover <> 13 then pm2_5 end as pm2_5,
                    case when cloud_cover <> 17 then ozone end as ozone)
  from obs),
hourly as (
  select * replace (date_trunc('hour', timestamp) as timestamp) from obs_null
  qualify row_number() over (partition by city, date_trunc('hour', timestamp) order by event_id desc) = 1)"""
