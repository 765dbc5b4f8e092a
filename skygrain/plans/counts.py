"""How many rows and columns each step of a job handed on, counted while they are written."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skygrain.plans.store import Store
from skygrain.session import durable
from skygrain.sources.feature_table import table_exists
from skygrain.sources.registry import run_stamp

SCHEMA = "run_id string, job string, step string, position int, rows long, columns int"


class Counts:
    """The steps of one run. A step is counted by the write it has anyway: there is no job for it."""

    def __init__(self, job: str, as_of: datetime):
        self.job, self.run_id = job, run_stamp(as_of)
        self.steps: list[tuple[str, int, int]] = []

    def durable(self, df: DataFrame, step: str) -> DataFrame:
        """``session.durable``, counted."""
        seen = Observation(step)
        out = durable(df.observe(seen, F.count(F.lit(1)).alias("rows")), step)
        self.note(step, seen.get["rows"], len(df.columns))
        return out

    def note(self, step: str, rows: int, columns: int = 1) -> None:
        """A number that is known already, of models or files, say."""
        self.steps.append((step, int(rows), columns))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.run_id, self.job, step, i, rows, columns) for i, (step, rows, columns) in enumerate(self.steps)], SCHEMA)

    def write(self, spark: SparkSession, store: Store) -> None:
        self.table(spark).coalesce(1).write.mode("append").parquet(store.runs)


def written(counts: Counts | None, df: DataFrame, step: str) -> DataFrame:
    """``session.durable``, counted if somebody counts."""
    return durable(df, step) if counts is None else counts.durable(df, step)


def read_counts(spark: SparkSession, store: Store, run_id: str | None = None) -> DataFrame:
    """The steps of all runs, or of one."""
    if not table_exists(spark, store.runs):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(store.runs)
    return rows if run_id is None else rows.filter(F.col("run_id") == run_id)
