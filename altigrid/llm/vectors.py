"""Vectors of numbers as rows for numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def is_whole(v: str) -> Column:
    """Whether a vector is given, has components, and all are finite."""
    return F.expr(f"{v} IS NOT NULL AND size({v}) > 0 AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")


def scaled(v: str, scale: int) -> Column:
    """floor(scale * x) of each component, taken as double, as long."""
    return F.transform(F.col(v), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def integer_rows(df: DataFrame, vector: str, scale: int) -> DataFrame:
    """Rows whose vector is whole, with `x` (array<long>) and `dim` in place of the vector."""
    return df.where(is_whole(vector)).withColumn("x", scaled(vector, scale)).withColumn("dim", F.size("x")).drop(vector)


def by_dim(batch: pa.RecordBatch, column: str = "x"):
    """For each vector length in a batch: (length, places of its rows, matrix of their components)."""
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        part = batch.column(column) if len(own) == len(dims) else batch.column(column).take(pa.array(own))
        yield dim, own, np.asarray(part.flatten()).reshape(-1, dim)


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(kind)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; in floating point only where no sum can leave 53 bits."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T
