"""Keyed Parquet tables that only grow: versions are appended, merged on read, and compacted apart.

A write adds one *version*: its rows, dealt by month of their time and by a hash of their key into buckets, and after them a
few manifest rows that say which buckets the version has. A version without manifest rows is not there, so a write that
fails, or runs beside a read or another write, is never seen in part. Nothing that is stored is read or moved by a write.

A read asks the manifest. Buckets with one version hold every key once and are read as they are; rows of the other buckets are
reduced to the newest version of each key. Compaction writes the reduced rows of the buckets with the largest share of
replaced rows as a new version that stands for all older ones of those buckets; files that no read needs any more are
deleted by ``vacuum``.

The driver sees the manifest rows of the wanted months, a row for each bucket and version, never data.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


MONTH, BUCKET, VERSION = "event_month", "_bucket", "_version"
BUCKETS = 16
# The month of tables without a time, and of rows whose time is missing.
NO_MONTH = "none"
_MANIFEST = f"{VERSION} string, {MONTH} string, {BUCKET} int, n long, replaces array<string>, fields string, buckets int"


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(f"{path}/manifest")
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def manifest(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> list:
    """Manifest rows that reads need, oldest first: those no compacted version stands for."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    if months is not None:
        rows = rows.filter(F.col(MONTH).isin(list(months)))
    found = rows.collect()
    gone = {(v, r[MONTH], r[BUCKET]) for r in found for v in r.replaces or ()}
    return sorted((r for r in found if (r[VERSION], r[MONTH], r[BUCKET]) not in gone), key=lambda r: r[VERSION])


def months(spark: SparkSession, path: str) -> list[str]:
    """The months that have rows, in order."""
    return sorted({r[MONTH] for r in manifest(spark, path)})


def _schema(rows: Sequence) -> T.StructType:
    """All columns any version has, those of the newest first."""
    fields: dict[str, T.StructField] = {}
    for text in dict.fromkeys(r.fields for r in reversed(rows)):
        for f in T.StructType.fromJson(json.loads(text)).fields:
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


def _scan(spark: SparkSession, path: str, schema: T.StructType, rows: Sequence) -> DataFrame:
    """Rows of the given manifest rows, with month, bucket and version; only their folders are listed."""
    full = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType()), T.StructField(MONTH, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    folders = [f"{path}/data/{VERSION}={r[VERSION]}/{MONTH}={r[MONTH]}/{BUCKET}={r[BUCKET]}" for r in rows]
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders)


def newest_of(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the greatest by ``order``.

    An aggregate, not a ranking window: copies of a key are reduced before the shuffle, so a key with very many
    copies does not fill one task.
    """
    rest = [c for c in df.columns if c not in keys]
    # keys come from the group, so that a filter on them reaches the scan
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def _merged(spark: SparkSession, path: str, rows: Sequence, keys: Sequence[str]) -> DataFrame:
    schema, by_place = _schema(rows), defaultdict(list)
    for r in rows:
        by_place[r[MONTH], r[BUCKET]].append(r)
    alone = [rs[0] for rs in by_place.values() if len(rs) == 1]
    several = [r for rs in by_place.values() if len(rs) > 1 for r in rs]
    parts = []
    if alone or not several:
        parts.append(_scan(spark, path, schema, alone))
    if several:
        parts.append(newest_of(_scan(spark, path, schema, several), [MONTH, *keys], F.col(VERSION)))
    return reduce(DataFrame.unionByName, parts).drop(VERSION)


def read(spark: SparkSession, path: str, keys: Sequence[str], months: Sequence[str] | None = None) -> DataFrame:
    """The current row of every key, with its month (``event_month``); ``months`` reads only the files of those."""
    rows = manifest(spark, path, months)
    if not rows:
        every = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").select(VERSION, "fields").distinct().collect()
        return _scan(spark, path, _schema(sorted(every, key=lambda r: r[VERSION])), []).drop(VERSION, BUCKET)
    return _merged(spark, path, rows, keys).drop(BUCKET)


def append(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], time: str | None = None, buckets: int = BUCKETS,
) -> None:
    """Insert rows, or replace those with the same key; ``batch`` has every key once.

    A key's time never changes, as it is part of the key; without ``time`` the table has one month. The
    number of buckets is that of the first version. Rows are laid out so that a month that holds most of them is written by many tasks.
    """
    known = manifest(spark, path) if exists(spark, path) else []
    count = known[0].buckets if known else buckets
    month = F.coalesce(F.date_format(time, "yyyy-MM"), F.lit(NO_MONTH)) if time else F.lit(NO_MONTH)
    place = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    last = max((int(r[VERSION][1:13]) for r in known), default=0)
    # two writers at once get different versions, in an order that all readers see
    version = f"v{last + 1:012d}-{uuid.uuid4().hex[:8]}"
    _commit(spark, path, batch.withColumns({MONTH: month, BUCKET: place}), keys, version, count, {})


def _commit(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], version: str, buckets: int, replaces: dict[tuple, list[str]]) -> None:
    fields = json.dumps(T.StructType([f for f in rows.schema.fields if f.name not in (MONTH, BUCKET)]).jsonValue())
    dealt = rows.hint("rebalance", F.col(MONTH), F.col(BUCKET)).sortWithinPartitions(MONTH, BUCKET, *keys)
    folder = f"{path}/data/{VERSION}={version}"
    dealt.write.partitionBy(MONTH, BUCKET).parquet(folder)
    # a row for each bucket; the footers know how many rows a file has
    counts = spark.read.schema(f"{MONTH} string, {BUCKET} int").parquet(folder).groupBy(MONTH, BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
    entries = [(version, r[MONTH], r[BUCKET], r.n, replaces.get((r[MONTH], r[BUCKET]), []), fields, buckets) for r in counts]
    if entries or not exists(spark, path):
        entries = entries or [(version, NO_MONTH, 0, 0, [version], fields, buckets)]  # an empty table, for its columns
        spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _files(spark: SparkSession, folder: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def stale(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``event_month, _bucket, n, current`` of every bucket with several versions: its stored and its current rows.

    Only keys are read.
    """
    rows = manifest(spark, path)
    places = defaultdict(list)
    for r in rows:
        places[r[MONTH], r[BUCKET]].append(r)
    several = [r for rs in places.values() if len(rs) > 1 for r in rs]
    if not several:
        return spark.createDataFrame([], f"{MONTH} string, {BUCKET} int, n long, current long")
    found = _scan(spark, path, _schema(rows), several).groupBy(MONTH, BUCKET, *keys).agg(F.count(F.lit(1)).alias("_n"))
    return found.groupBy(MONTH, BUCKET).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("current"))


def compact(spark: SparkSession, path: str, keys: Sequence[str], share: float = 0.2) -> int:
    """Rewrite the buckets in which more than ``share`` of the stored rows are replaced; returns their number.

    Versions that are written meanwhile stay newer than the compacted rows.
    """
    rows = manifest(spark, path)
    chosen = {(r[MONTH], r[BUCKET]) for r in stale(spark, path, keys).filter(F.col("n") - F.col("current") > share * F.col("n")).collect()}
    if not chosen:
        return 0
    replaces = defaultdict(list)
    for r in rows:
        if (r[MONTH], r[BUCKET]) in chosen:
            replaces[r[MONTH], r[BUCKET]].append(r[VERSION])
    some = [r for r in rows if (r[MONTH], r[BUCKET]) in chosen]
    # newer than all it stands for, older than what is written after them
    version = f"{some[-1][VERSION]}~{uuid.uuid4().hex[:8]}"
    _commit(spark, path, _merged(spark, path, some, keys), keys, version, rows[0].buckets, replaces)
    return len(chosen)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of buckets that no read of the current manifest needs; returns their number.

    Not to be run beside a write or a read that began before the last compaction.
    """
    live = {(r[VERSION], r[MONTH], r[BUCKET]) for r in manifest(spark, path)}
    every = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").select(VERSION, MONTH, BUCKET).collect()
    gone = {tuple(r) for r in every} - live
    for version, month, bucket in gone:
        files, place = _files(spark, f"{path}/data/{VERSION}={version}/{MONTH}={month}/{BUCKET}={bucket}")
        files.delete(place, True)
    return len(gone)
