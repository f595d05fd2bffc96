"""Vectors as exact integers: rows that can be compared, and Arrow lists as matrices by length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vec: Column | str) -> Column:
    """True where a vector is not null and all its components are finite numbers."""
    v = F.col(vec) if isinstance(vec, str) else vec
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return v.isNotNull() & F.coalesce(whole, F.lit(False))


def integers(vec: Column | str, scale: int = 256) -> Column:
    """Components, as double, times ``scale`` and rounded down, as long; beyond the range of a long, its nearest value."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """(length, matrix, rows) for each length among the vectors of a batch."""
    sizes = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes).tolist():
        part = batch if (sizes == d).all() else batch.filter(pa.array(sizes == d))
        flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
        yield d, flat.reshape(part.num_rows, d), part


def peak(a: np.ndarray) -> int:
    """Largest magnitude, as an exact integer."""
    return max(int(a.max()), -int(a.min())) if a.size else 0
