"""Helpers the operators share: folds, samples of a stated size, groups of a sorted stream."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Documents are handed to Python in pieces of so many rows, so that long texts do not add up.
SLICE_ROWS = 128
# Cells whose rows ``weighted_sums`` gathers at a time, as many as a core's cache holds.
GATHER = 1 << 13


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key written as text, modulo ``parts``; -1 for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts)), F.lit(-1)).cast("int")


# Text that travels to a Python worker at a time; Spark's own bound is 64 MB, once in the executor and once in each worker.
BATCH_BYTES = 8 << 20


def small_batches(spark) -> None:
    """Have whole texts handed to Python in batches of ``BATCH_BYTES``; a setting of the session, for speed and memory only."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``; empty batches are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_slices(batches: Iterable[pa.RecordBatch], column: int, size: int, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, each of one row or at most ``size`` bytes of the text or binary ``column``."""
    for batch in slices(batches, rows):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def rows_for(total: int, share: int, least: int = 1) -> int:
    """Number of parts of about ``share`` that make up ``total``."""
    return max(least, -(-int(total or 0) // share))


def ragged(arrays: list[np.ndarray], value_type: pa.DataType) -> pa.Array:
    """A list column from one flat array per row."""
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=value_type))


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a stream sorted by ``keys`` (integers, no nulls).

    Each table has at least one group; the rows of a group are never split, and
    only the last group of a batch waits for the next one.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        changes = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        if rest:
            last = rest[-1]
            joined = all(last.column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
            if not joined:
                yield pa.Table.from_batches(rest)
                rest = []
        if not len(changes):
            rest.append(batch)
            continue
        yield pa.Table.from_batches([*rest, batch.slice(0, int(changes[-1]))])
        rest = [batch.slice(int(changes[-1]))]
    if rest:
        yield pa.Table.from_batches(rest)


def bounds(key: np.ndarray) -> np.ndarray:
    """Start of every run of equal rows of ``key`` (2-d), and the end of the last."""
    if not len(key):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])


def weighted_sums(value: np.ndarray, index: np.ndarray, rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of ``value`` times the rows of ``index`` from each cut to the next.

    Runs are filled up to the next power of two, so that those of about one length are one stack of products; long ones are added up piece by piece.
    """
    out = np.zeros((len(cuts) - 1, rows.shape[1]))
    run, start, size = np.arange(len(cuts) - 1), cuts[:-1], np.diff(cuts)
    while len(run):
        here = np.minimum(size, GATHER)
        kind = np.ceil(np.log2(here)).astype(np.int64)
        for k in np.unique(kind).tolist():
            some = np.flatnonzero(kind == k)
            step = max(1, GATHER >> k)
            for low in range(0, len(some), step):
                part = some[low:low + step]
                place = np.arange(1 << k)
                inside = place < here[part][:, None]
                cell = np.where(inside, start[part][:, None] + place, 0)
                weight = np.where(inside, value[cell], 0)
                out[run[part]] += np.matmul(weight[:, None, :], rows[index[cell]])[:, 0]
        more = np.flatnonzero(size > GATHER)
        run, start, size = run[more], start[more] + GATHER, size[more] - GATHER
    return out


def cuts_of(sorted_numbers: np.ndarray) -> np.ndarray:
    """Where runs of one number begin, and the end of the last."""
    return np.flatnonzero(np.concatenate([[True], sorted_numbers[1:] != sorted_numbers[:-1], [True]])) if len(sorted_numbers) else np.zeros(1, np.int64)
