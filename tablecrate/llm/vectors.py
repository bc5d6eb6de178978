"""Vectors as matrices: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scaled components are held within this: beyond any embedding, and sums stay in 64 bits.
LARGEST = float(1 << 31)


def is_whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, a whole number held as a double."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(LARGEST)), F.lit(-LARGEST)))
    return F.transform(vector, lambda x: whole(x).cast("double"))


def width(df: DataFrame, vector: str) -> int:
    """The length of the longest vector."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.ListArray, columns: int) -> np.ndarray:
    """A row a vector; shorter ones end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == len(column) * columns:
        return flat.reshape(len(column), columns)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), columns))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def to_long(values: np.ndarray) -> np.ndarray:
    """Whole numbers as longs; what is too large becomes the largest long."""
    most = np.iinfo(np.int64).max
    return np.where(np.abs(values) < 2.0**63, values, 0).astype(np.int64) + np.where(values >= 2.0**63, most, 0) - np.where(values <= -(2.0**63), most, 0)
