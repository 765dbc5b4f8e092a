"""Session defaults for local runs, and the durable scratch tables of long plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}

# A side with more rows than this is never hinted as a broadcast.
BROADCAST_ROWS = 200_000


# Runtime settings the plans of this library are written for.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Java does not compile methods beyond 8000 bytes; the default lets the band
    # ladders grow past that and run interpreted, at less than half the speed
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = 8, name: str = "skygrain") -> SparkSession:
    return tune(
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # noting the Python call site of every expression doubles the time to build wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``. Only a local master may go
    without: executors of a cluster cannot read a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="skygrain-")
    return _local_folders[context.applicationId]


def durable(df: DataFrame, label: str = "part") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, is computed once however often it is used, and
    survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if, and only if, ``df`` has been counted to be small."""
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else df
