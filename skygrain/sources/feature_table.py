"""Keyed tables of observations and features: upsert, newest rows, training frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain import schema as S
from skygrain.operators import selection
from skygrain.operators.features import feature_columns
from skygrain.operators.series import newest
from skygrain.sources import versioned
from skygrain.sources.versioned import MONTH

PRIMARY_KEY = ("city", S.TIME)
INGESTED = "ingest_ts"


def latest_versions(
    df: DataFrame, keys: Sequence[str] = PRIMARY_KEY, version: str = INGESTED,
    ties: Sequence[str] = (),
) -> DataFrame:
    """One row per key, the one with the greatest version; see ``versioned.newest_of``."""
    return versioned.newest_of(df, keys, F.struct(version, *ties))


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def upsert(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str] = PRIMARY_KEY,
    time: str | None = S.TIME, unique: bool = False,
) -> None:
    """Insert rows or replace those with the same key; create the table if needed.

    Of copies within the batch the latest version counts; ``unique`` says there are
    none. The batch becomes a version of the table (``versioned``): stored rows are neither read nor moved.
    """
    # of copies of one version the greatest row counts, in whatever order they were written
    ties = [f.name for f in batch.schema.fields if f.name not in keys and isinstance(f.dataType, T.AtomicType)]
    versioned.append(spark, path, batch if unique else latest_versions(batch, keys, ties=ties), keys, time)


def read_table(
    spark: SparkSession, path: str, months: Sequence[str] | None = None, keys: Sequence[str] = PRIMARY_KEY,
) -> DataFrame:
    """The current rows, with the month each is stored in; ``months`` opens only the files of those."""
    return versioned.read(spark, path, keys, months)


def read_newest(
    spark: SparkSession, path: str, limit: int | None, keys: Sequence[str] = ()
) -> DataFrame:
    """Newest rows of a table, overall or per key; all rows if ``limit`` is None."""
    return newest(read_table(spark, path).drop(INGESTED, MONTH), limit, keys, (S.TIME, "city"))


def random_split(
    df: DataFrame, keys: Sequence[str] = PRIMARY_KEY, share: float = S.TRAIN_SHARE, seed: int = 42
) -> DataFrame:
    """Add ``split`` by a hash of the key: the same rows whatever the partitioning, and exactly ``floor(n * share)`` of them."""
    return selection.random_split(df, keys, share, seed)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str] = PRIMARY_KEY, seed: int = 42) -> DataFrame:
    """``n`` rows picked by a hash of the key, the same on every run."""
    return selection.sample_rows(df, n, keys, seed)


def training_frame(features: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with a known single-horizon target, and the columns to train on."""
    rows = features.filter(F.col(S.TARGET).isNotNull())
    return rows, [c for c in feature_columns(rows, legacy=True) if c not in PRIMARY_KEY]
