"""Whitening of embeddings by the leading components of their covariance.

Components become x = floor(scale * c) as long. The fit list is each distinct x
once, so copies do not weigh; it is reduced to n, exact sums and, centred before
multiplying, a covariance: each task adds one matrix per vector length, a second
stage adds those, and the driver gets a number of matrices that does not grow with
the rows. Eigenpairs come from spectrum slicing (see spectrum.py), on a matrix as
wide as a vector. Rows are then projected where they are.

Rows whose vector is null, empty or holds null or non-finite entries take no part.
Vectors of each length are fitted on their own. A row with null vec_id and equal
rows stay rows. Fewer components than asked for are returned where the covariance
has fewer eigenvalues above rounding: none for a single distinct vector, and
vectors of dimension d have d at most. n * x and the deviation must fit 64 bits.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from altigrid.llm.common import discard, saved
from altigrid.llm.spectrum import leading
from altigrid.llm.vectors import by_dim, integer_rows

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
MERGES = 16  # tasks of the second stage of a sum


def _summed(rows: DataFrame, of: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Per vector length the sum of of(dim, x) over all batches, in two stages of tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in by_dim(batch):
                part = of(dim, x)
                held[dim] = held[dim] + part if dim in held else part
        yield _rows(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, raw, kind in zip(*(batch.column(c).to_pylist() for c in ("dim", "raw", "kind"))):
                part = np.frombuffer(raw, kind)
                held[dim] = held[dim] + part if dim in held else part
        yield _rows(held)

    def _rows(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([m.tobytes() for m in held.values()], pa.binary()), pa.array([m.dtype.str for m in held.values()], pa.string())],
            names=["dim", "raw", "kind"])

    schema = "dim int, raw binary, kind string"
    total: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(add, schema).repartition(MERGES).mapInArrow(merge, schema).toLocalIterator():
        part = np.frombuffer(r.raw, r.kind)
        total[r.dim] = total[r.dim] + part if r.dim in total else part
    return total


class Model:
    """Mean and scaled components of one vector length."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.sums = n, sums
        self.values, self.axes = np.zeros(0), np.zeros((0, len(sums)))
        self.trace, self.error = 0.0, 0.0

    def fit(self, covariance: np.ndarray, most: int) -> None:
        self.trace = float(np.trace(covariance))
        self.values, self.axes = leading(covariance, most)

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x - self.sums

    def whiten(self, moved: np.ndarray) -> np.ndarray:
        return (moved / self.n) @ (self.axes / np.sqrt(self.values)[:, None]).T


def _counts(_: int, x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(axis=0)])


def fit(rows: DataFrame, most: int = 4) -> dict[int, Model]:
    """A model for each vector length in rows (dim, x), which are distinct."""
    models = {dim: Model(int(s[0]), s[1:]) for dim, s in _summed(rows, _counts).items()}

    def products(dim: int, x: np.ndarray) -> np.ndarray:
        centred = models[dim].moved(x) / models[dim].n
        return (centred.T @ centred).ravel()

    for dim, total in _summed(rows, products).items():
        models[dim].fit(total.reshape(dim, dim) / models[dim].n, most)

    def whitened(dim: int, x: np.ndarray) -> np.ndarray:
        return models[dim].whiten(models[dim].moved(x)).sum(axis=0)

    means = {dim: total / models[dim].n for dim, total in _summed(rows, whitened).items()}

    def errors(dim: int, x: np.ndarray) -> np.ndarray:
        w = models[dim].whiten(models[dim].moved(x)) - means[dim]
        return (w.T @ w).ravel()

    for dim, total in _summed(rows, errors).items():
        k = len(models[dim].values)
        models[dim].error = float(np.abs(total.reshape(k, k) / models[dim].n - np.eye(k)).max(initial=0.0))
    return models


def whiten(embeddings: DataFrame, scale: int = 256, most: int = 4) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = integer_rows(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "embedding", scale)
    distinct = saved(rows.select("dim", "x").distinct())
    models = fit(distinct, most)
    discard(distinct)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, x in by_dim(batch):
                model = models[dim]
                k, n = len(model.values), len(x)
                moved = model.moved(x)
                deviation = (moved * moved).sum(axis=1)
                ids = batch.column("vec_id").take(pa.array(np.repeat(own, k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, model.n)),
                    pa.array(np.repeat(deviation, k)), pa.array(model.whiten(moved).ravel()),
                    pa.array(np.tile(model.values / model.trace if model.trace else model.values, n)), pa.array(np.full(n * k, model.error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "dim", "x").mapInArrow(project, SCHEMA)
