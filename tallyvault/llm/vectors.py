"""Rows of ``embeddings`` as integer vectors, shared by the operators on vectors.

A vector that is null, or that holds a null, NaN or infinite entry, is dropped; an empty one
stays.  Vectors of unlike lengths are filled up with zeros to the longest one's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task turns into one matrix; bounds its memory whatever the batches of the session hold.
ROWS = 8192


def integer_vectors(embeddings: DataFrame, scale: int, *columns: str | Column) -> DataFrame:
    """The named columns and ``x`` (array of long): every entry c as floor(scale * c), for vectors that are whole."""
    c = F.col("embedding").cast("array<double>")
    whole = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    return embeddings.where(whole).select(*columns, F.transform(c, lambda v: F.floor(v * F.lit(float(scale)))).alias("x"))


def lengths(rows: DataFrame) -> tuple[int, int, int]:
    """Number of rows, least and greatest length of ``x`` (zeros where there is no row)."""
    r = rows.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    return r[0], r[1] or 0, r[2] or 0


def filled(x: str | Column, length: int) -> Column:
    """``x`` with zeros behind it up to ``length`` entries."""
    x = F.col(x) if isinstance(x, str) else x
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(length) - F.size(x), F.lit(0))))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column without nulls, all of ``length`` entries, as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), length)


def parts(batch: pa.RecordBatch, rows: int = ROWS):
    """The batch in slices of bounded size."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
