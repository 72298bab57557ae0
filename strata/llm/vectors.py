"""Vector columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """Neither null nor empty, and without null or non-finite components."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & fine, F.lit(False))


def matrix(column, dims: int, dtype) -> np.ndarray:
    """A binary Arrow column of vectors of ``dims`` components as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data = b"".join(x.as_py() for x in column) if not isinstance(column, (list, np.ndarray)) else b"".join(column)
    return np.frombuffer(data, dtype).reshape(-1, dims).astype(np.float64) if data else np.zeros((0, dims))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, without overflow; zero rows stay zero."""
    top = np.abs(x).max(axis=1, initial=0)
    x = x / np.where(top == 0, 1, top)[:, None]
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norm == 0, 1, norm)[:, None]
