"""Least squares from one pass: mergeable centred cross products, and the solutions of all targets.

Every task reduces its rows to one block: their number, the mean of every column and the products of all
centred columns, targets among them. Two blocks merge into the block of all their rows without cancellation, in any
order, so blocks are merged up a tree of bounded width. What reaches the driver is a few blocks whose size
depends on the number of columns alone. Each target then takes one Cholesky solution.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrain.session import durable

# Blocks that one task, or the driver, merges.
WIDTH = 32
_SCHEMA = "n long, mean array<double>, products array<double>"


@dataclass(frozen=True)
class Gram:
    """Rows, column means and centred cross products of the named columns."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    products: np.ndarray

    def merge(self, other: "Gram") -> "Gram":
        n = self.n + other.n
        if not other.n or not self.n:
            return self if self.n else other
        apart = other.mean - self.mean
        return Gram(self.columns, n, self.mean + apart * (other.n / n), self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n))

    def ridge(self, features: Sequence[str], target: str, alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept that minimise the squared error plus ``alpha`` times the squared coefficients.

        The intercept is not penalised. A constant feature gets 0. With ``alpha`` 0 the features must be independent.
        """
        at = [self.columns.index(c) for c in features]
        y = self.columns.index(target)
        lower = np.linalg.cholesky(self.products[np.ix_(at, at)] + alpha * np.eye(len(at)))
        w = np.linalg.solve(lower.T, np.linalg.solve(lower, self.products[at, y]))
        return w, float(self.mean[y] - w @ self.mean[at])

    def varying(self, columns: Sequence[str]) -> list[str]:
        """Columns that are not constant, to the precision of their values."""
        at = [self.columns.index(c) for c in columns]
        spread = np.sqrt(np.diag(self.products)[at] / max(self.n, 1))
        return [c for c, s, m in zip(columns, spread, np.abs(self.mean[at])) if s > 1e-12 * m]


@dataclass(frozen=True)
class Linear:
    """A linear model: a coefficient for each feature, in order, and an intercept."""

    coefficients: DenseVector
    intercept: float

    def prediction(self, values: str, names: Sequence[str], features: Sequence[str]) -> Column:
        """The prediction from an array column with a value for each of ``names``; those that are no feature count 0."""
        known = dict(zip(features, self.coefficients.toArray().tolist()))
        weights = ", ".join(f"{known.get(n, 0.0)!r}D" for n in names)
        return F.expr(f"aggregate(zip_with({values}, array({weights}), (x, w) -> x * w), {self.intercept!r}D, (total, x) -> total + x)")


def with_linear(df: DataFrame, values: str, names: Sequence[str], models: dict[str, tuple[Linear, Sequence[str]]]) -> DataFrame:
    """``df`` with a column of predictions for each model in place of ``values``, an array with a value for each of ``names``.

    A matrix product for each batch; a feature that a model does not have counts 0.
    """
    weights = np.zeros((len(names), len(models)))
    place = {n: i for i, n in enumerate(names)}
    for k, (model, features) in enumerate(models.values()):
        weights[[place[f] for f in features], k] = model.coefficients.toArray()
    base = np.array([model.intercept for model, _ in models.values()])
    rest, at = df.drop(values), df.columns.index(values)
    columns, made = rest.columns, list(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(at).flatten().to_numpy().reshape(batch.num_rows, len(names))
                found = (x @ weights + base).T
                others = [c for i, c in enumerate(batch.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*others, *[pa.array(p, pa.float64()) for p in found]], [*columns, *made])

    return df.mapInArrow(run, T.StructType([*rest.schema.fields, *[T.StructField(name, T.DoubleType()) for name in models]]))


def block(columns: Sequence[str], rows: np.ndarray) -> Gram:
    """The block of some rows (a row each, no missing values)."""
    n, p = rows.shape
    if not n:
        return Gram(tuple(columns), 0, np.zeros(p), np.zeros((p, p)))
    mean = rows.mean(axis=0)
    apart = rows - mean
    return Gram(tuple(columns), n, mean, apart.T @ apart)


def _write(g: Gram) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([g.n], pa.int64()), pa.array([g.mean.tolist()], pa.list_(pa.float64())), pa.array([g.products.ravel().tolist()], pa.list_(pa.float64()))],
        ["n", "mean", "products"])


def _read(batches: Iterable[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[Gram]:
    p = len(columns)
    for batch in batches:
        for n, mean, products in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            yield Gram(columns, n, mean.values.to_numpy(), products.values.to_numpy().reshape(p, p))


def gram(df: DataFrame, columns: Sequence[str], width: int = WIDTH) -> Gram:
    """The block of all rows of ``df`` that have a value in every column; one scan of those columns.

    NaN counts as missing, as everywhere. A table without such rows gives 0 rows.
    """
    names = tuple(columns)
    complete = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double")) for c in names])
    rows = df.filter(complete).select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    return _reduced(rows, names, lambda batch: np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1), width)


def gram_of_vectors(df: DataFrame, vector: str, features: Sequence[str], targets: Sequence[str], width: int = WIDTH) -> Gram:
    """The same from a complete feature vector and some target columns without missing values."""
    rows = df.select(vector_to_array(vector).alias("x"), *[F.col(f"`{c}`").cast("double").alias(c) for c in targets])

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, len(features))
        return np.column_stack([x, *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]])

    return _reduced(rows, (*features, *targets), matrix, width)


def _reduced(rows: DataFrame, names: tuple[str, ...], matrix: Callable[[pa.RecordBatch], np.ndarray], width: int) -> Gram:
    empty = block(names, np.empty((0, len(names))))

    def reduce_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = reduce(Gram.merge, (block(names, matrix(b)) for b in batches if b.num_rows), empty)
        if total.n:
            yield _write(total)

    def merge_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = reduce(Gram.merge, _read(batches, names), empty)  # about ``width`` of them
        if total.n:
            yield _write(total)

    blocks = durable(rows.mapInArrow(reduce_rows, _SCHEMA), "gram")
    while (count := blocks.count()) > width:
        # dealt round robin, so no task gets more than its share
        blocks = durable(blocks.repartition(-(-count // width)).mapInArrow(merge_blocks, _SCHEMA), "gram")
    found = (Gram(names, r.n, np.array(r.mean), np.array(r.products).reshape(len(names), -1)) for r in blocks.collect())
    return reduce(Gram.merge, found, empty)
