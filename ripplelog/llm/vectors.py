"""Vectors of whole numbers from columns of floating-point components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str, dims: int | None = None) -> Column:
    """Whether a vector is there, has ``dims`` components (any number if None), and all are finite."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.forall(F.col(vector).cast("array<double>"), good)
    size = F.lit(True) if dims is None else F.size(vector) == dims
    return F.coalesce(F.col(vector).isNotNull() & size & whole, F.lit(False))


def whole_numbers(column: pa.Array, scale: int, dims: int, most: int) -> np.ndarray:
    """floor(scale * x) of each component as an int64 matrix, a row for each vector.

    ArithmeticError if a number is beyond ``most`` either way, as sums of products could then leave
    64 bits; nothing is ever rounded or wrapped.
    """
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale)
    if len(scaled) and not np.abs(scaled).max() <= most:
        raise ArithmeticError(f"a component times {scale} is beyond {most}, where 64-bit results end")
    return scaled.astype(np.int64).reshape(len(column), dims)
