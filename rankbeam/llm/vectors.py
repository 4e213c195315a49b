"""Vector columns as numpy matrices inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, no null and no non-finite component."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~bad


def matrix(col: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of a list column as float64; shorter rows are padded with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(False).astype(np.float64)
    lens = np.diff(col.offsets.to_numpy(False)) if len(col) else np.zeros(0, np.int64)
    dim = dim if dim is not None else int(lens.max(initial=0))
    if len(lens) and (lens == dim).all():
        return flat.reshape(len(col), dim)
    out = np.zeros((len(col), dim))
    at = np.concatenate([[0], np.cumsum(lens)])
    for i, n in enumerate(lens.tolist()):
        out[i, :min(n, dim)] = flat[at[i]:at[i] + min(n, dim)]
    return out


def lists(m: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column."""
    off = np.arange(len(m) + 1, dtype=np.int32) * (m.shape[1] if m.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(m.reshape(-1)))
