"""Landed hourly payloads: one JSON object with parallel arrays per request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions.calendar import in_days
from skygrain.functions.numbers import nan_to_null
from skygrain.session import small_side
from skygrain.sources.versioned import newest_of

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def read_payloads(
    spark: SparkSession, path: str, variables: Sequence[str], modified_after: str | None = None
) -> DataFrame:
    """Raw objects of all files below ``path``; unreadable ones come as NULLs.

    ``modified_after`` (``yyyy-MM-ddTHH:mm:ss``) skips older files without opening
    them, so an update need not read the whole landing folder again.
    """
    reader = (spark.read.schema(S.payload_schema(list(variables)))
              .option("multiLine", True).option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", True))
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.json(path).withColumns({"file": F.input_file_name(), "modified": F.col("_metadata.file_modification_time")})


def is_usable(variables: Sequence[str]) -> Column:
    """A payload counts if it has hours, equally long arrays and readable times."""
    hours = F.size("hourly.time")
    usable = F.coalesce(hours > 0, F.lit(False)) & F.coalesce(
        F.forall("hourly.time", lambda t: F.try_to_timestamp(t, F.lit(TIME_FORMAT)).isNotNull()),
        F.lit(False))
    for v in variables:
        values = F.col(f"hourly.{v}")
        usable = usable & (values.isNull() | (F.size(values) == hours))
    return usable


def payload_rows(payloads: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row per city and hour; unusable payloads yield none."""
    return _exploded(payloads, variables).select("city", S.TIME, *variables)


def _exploded(payloads: DataFrame, variables: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    arrays = F.arrays_zip(F.col("hourly.time").alias("time"), *[
        F.coalesce(F.col(f"hourly.{v}"), F.array().cast("array<double>")).alias(v) for v in variables])
    rows = payloads.filter(is_usable(variables)).select("city", *carry, F.posexplode(arrays).alias("_place", "h"))
    return nan_to_null(rows.select(
        "city", F.to_timestamp("h.time", TIME_FORMAT).alias(S.TIME),
        *[F.col(f"h.{v}").alias(v) for v in variables], *carry, "_place"))


def newest_readings(payloads: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row per city and hour: of files that hold the same hour the one written last counts.

    A correction that is landed beside the file it corrects therefore wins, whatever its values; of files written at the
    same moment the greatest name, within a file the last entry.
    """
    rows = _exploded(payloads, variables, ["modified", "file"])
    best = newest_of(rows, ["city", S.TIME], F.struct("modified", "file", "_place"))
    return best.select("city", S.TIME, *variables)


def rejected(payloads: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Files whose payload is not usable."""
    return payloads.filter(~is_usable(variables)).select("file", "city")


def read_air(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    return newest_readings(read_payloads(spark, path, S.POLLUTANTS, modified_after), S.POLLUTANTS)


def read_weather(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    return newest_readings(read_payloads(spark, path, S.WEATHER, modified_after), S.WEATHER)


def join_inputs(air: DataFrame, weather: DataFrame, keys: Sequence[str] = ("city", S.TIME)) -> DataFrame:
    """Hours that have both. ``read_air`` and ``read_weather`` give each hour once; repeated ones would multiply."""
    return air.join(weather, list(keys), "inner")


def with_location(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Attach latitude and longitude by city; broadcast only if counted small."""
    return df.join(small_side(locations.select("city", "latitude", "longitude")), "city", "left")


def observations(
    spark: SparkSession, air_path: str, weather_path: str, locations: DataFrame,
    start: str | None = None, end: str | None = None, modified_after: str | None = None,
) -> DataFrame:
    """The observation table from both landing folders, optionally from ``start`` or to ``end``, or both."""
    air = read_air(spark, air_path, modified_after)
    weather = read_weather(spark, weather_path, modified_after)
    if start or end:
        air, weather = in_days(air, start, end), in_days(weather, start, end)
    joined = with_location(join_inputs(air, weather), locations)
    return joined.select(*[F.col(f.name).cast(f.dataType) for f in S.OBSERVATIONS.fields])
