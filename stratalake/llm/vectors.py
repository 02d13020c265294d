"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a non-empty vector without NULL and non-finite components; never NULL."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """A list column whose rows have one length as a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(whole), -1)
