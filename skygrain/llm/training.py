"""Distributed training of small models: gradient steps per partition, parameters mixed after each round."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Parameters = dict[str, np.ndarray]


def share(key: list[Column], part: Column) -> Column:
    """Rows whose hash falls in the first ``part`` (0 to 1) of the hash range."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < part * float(1 << 30)


def pack(params: Parameters) -> np.ndarray:
    return np.concatenate([p.astype(np.float64).ravel() for p in params.values()])


def unpack(values: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for name, p in like.items():
        out[name] = values[at:at + p.size].reshape(p.shape).astype(p.dtype)
        at += p.size
    return out


def mix(rows: DataFrame, params: Parameters, rounds: int, improve: Callable[[pa.Table, Parameters, int], Parameters]) -> Parameters:
    """``params`` after ``rounds`` rounds of ``improve`` in every partition, averaged by rows.

    ``rows`` is a bounded sample, written beforehand, so its partitions and
    the parameters that come back from them are few.
    """
    for k in range(rounds):
        def run(batches: Iterable[pa.RecordBatch], params=params, k=k) -> Iterator[pa.RecordBatch]:
            batches = [b for b in batches if b.num_rows]
            if batches:
                part = pa.Table.from_batches(batches)
                values = pack(improve(part, params, k))
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int64()), pa.array([values.tobytes()])], ["n", "p"])

        found = rows.mapInArrow(run, "n long, p binary").collect()
        if not found:
            return params
        total = sum(r.n for r in found)
        params = unpack(sum(np.frombuffer(r.p) * (r.n / total) for r in found), params)
    return params


def sums(rows: DataFrame, count: Callable[[pa.Table], np.ndarray], size: int) -> np.ndarray:
    """Sum over the partitions of a bounded sample of what ``count`` makes of each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if batches:
            yield pa.RecordBatch.from_arrays([pa.array([count(pa.Table.from_batches(batches)).astype(np.float64).tobytes()])], ["p"])

    return sum((np.frombuffer(r.p) for r in rows.mapInArrow(run, "p binary").collect()), np.zeros(size))


# Tasks that add up what all others have found; one more adds up theirs, so that the driver gets one result, whatever the size of the table.
MERGES = 4


def totals(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], tuple[float, np.ndarray]], size: int) -> tuple[float, np.ndarray]:
    """Sums over the partitions of a table of any size of the number and the array that ``count`` makes of the stream of each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = count(b for b in batches if b.num_rows)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([found.astype(np.float64).tobytes()], pa.binary())], ["n", "p"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0.0, np.zeros(size)
        for batch in batches:
            n += sum(batch.column(0).to_pylist())
            for p in batch.column(1):
                found += np.frombuffer(p.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([found.tobytes()], pa.binary())], ["n", "p"])

    parts = rows.mapInArrow(run, "n double, p binary")
    for tasks in (MERGES, 1):
        parts = parts.repartition(tasks).mapInArrow(merge, "n double, p binary")
    parts = parts.collect()
    return sum(r.n for r in parts), sum((np.frombuffer(r.p) for r in parts), np.zeros(size))


def sweep(rows: DataFrame, params: Parameters, improve: Callable[[Iterator[pa.RecordBatch], Parameters], tuple[float, Parameters]]) -> Parameters:
    """``params`` after every partition has improved them along all of its rows, however many, averaged by the weight of the rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> tuple[float, np.ndarray]:
        weight, found = improve(batches, params)
        return weight, pack(found) * weight

    weight, total = totals(rows, count, len(pack(params)))
    return unpack(total / weight, params) if weight else params


class Adam:
    def __init__(self, params: Parameters, rate: float):
        self.params, self.rate, self.step = {k: p.copy() for k, p in params.items()}, rate, 0
        self.first = {k: np.zeros_like(p) for k, p in params.items()}
        self.second = {k: np.zeros_like(p) for k, p in params.items()}

    def update(self, gradient: Parameters) -> None:
        self.step += 1
        for k, g in gradient.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.999 * self.second[k] + 0.001 * g * g
            unbiased = self.first[k] / (1 - 0.9 ** self.step)
            self.params[k] -= self.rate * unbiased / (np.sqrt(self.second[k] / (1 - 0.999 ** self.step)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
