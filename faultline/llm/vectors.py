"""Vectors as the operators on embeddings need them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of rows with an id whose vector is not null, zero or empty and holds only finite numbers."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows; shorter ones count as followed by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, ends = np.asarray(column.flatten(), np.float64), np.cumsum(np.asarray(column.value_lengths()))
    if len(flat) == len(column) * width:
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    for i, (start, stop) in enumerate(zip([0, *ends[:-1]], ends)):
        out[i, : stop - start] = flat[start:stop]
    return out


def width(vectors: DataFrame) -> int:
    return vectors.agg(F.max(F.size("embedding"))).first()[0] or 0


def arrays(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, max(1, rows.shape[1])).astype(np.int32), rows.ravel())


Batches = Iterator[pa.RecordBatch]
