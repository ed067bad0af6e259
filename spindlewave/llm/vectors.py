"""Vectors from tables of embeddings, as rows of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCHEMA = "vec_id long, dim int, data binary"


def readable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, dim and data of all rows; data is null for a vector that takes no part.

    These are null or empty vectors, zero vectors, and those with null or non-finite
    components. Data are little-endian 64-bit floats.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            values = np.asarray(lists.values.cast(pa.float64()).fill_null(float("nan")))
            ends = np.asarray(lists.offsets)
            there = np.asarray(lists.is_valid())
            dims, data = [], []
            for a, b, valid in zip(ends[:-1].tolist(), ends[1:].tolist(), there.tolist(), strict=True):
                x = values[a:b]
                good = valid and b > a and bool(np.isfinite(x).all()) and bool(x.any())
                dims.append(b - a if valid else None)
                data.append(x.astype("<f8").tobytes() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(data, pa.binary())],
                ["vec_id", "dim", "data"],
            )

    rows = vectors.selectExpr(f"cast(`{id_column}` as long) as vec_id", f"cast(`{column}` as array<double>) as e")
    return rows.mapInArrow(read, SCHEMA)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a column of data, one a row; all have ``dim`` components."""
    if not len(column):
        return np.zeros((0, dim))
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch in parts whose vectors have the same number of components."""
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(dims == dim)))


BYTES = T.BinaryType()
