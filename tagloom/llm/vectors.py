"""Vectors of finite components as lists of integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Components from this size on count as non-finite: scaled, they stay far inside a long.
LIMIT = 2.0**40

_INTEGERS = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.int64()))])


def _integers(scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            # Null components come out as NaN.
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            finite = np.abs(flat) < LIMIT
            kept = np.ones(len(lengths), dtype=bool)
            kept[owner[~finite]] = False
            whole = np.floor(flat[kept[owner]] * scale).astype(np.int64) + shift
            offsets = np.concatenate(([0], np.cumsum(lengths[kept]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(kept)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole))],
                schema=_INTEGERS,
            )

    return run


def integer_vectors(
    rows: DataFrame, scale: int, shift: int = 0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id`` and ``x``, floor(scale * component) + shift, of every vector without null or non-finite components."""
    whole = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    return whole.where("x IS NOT NULL").mapInArrow(_integers(scale, shift), "vec_id long, x array<long>")


def flat_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and all components, one after the other, of a column of lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
