"""Vectors as whole numbers, packed: floor(scale * entry), 64-bit, little endian."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.llm.textbytes import sums

SCALE = 256
_LARGEST = float(2**63 - 1024)  # the largest double below 2^63


def whole_entries(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, entries): the rows whose vector is neither NULL nor empty and has finite entries only."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    value = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL becomes NaN
    right = (sums(~np.isfinite(value), np.concatenate([[0], np.cumsum(length)])) == 0) & (length > 0)
    entry = np.floor(value[np.repeat(right, length)] * scale)
    return np.flatnonzero(right), length[right], np.clip(entry, -_LARGEST, _LARGEST).astype(np.int64)


def packed(length: np.ndarray, entry: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(8 * length)]).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(entry.astype("<i8"))])
    return whole.cast(pa.binary())


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows x dimension, of packed vectors of that dimension."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dimension)


def whole_vectors(rows: DataFrame, keep: list[str], vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The columns ``keep`` and ``x``, the packed vector.

    Rows whose vector is NULL or empty or has a NULL or non-finite entry are left out;
    entries beyond 64 bits become the largest of their sign.
    """

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, length, entry = whole_entries(batch.column(len(keep)), scale)
            kept = [batch.column(i).take(pa.array(at)) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, packed(length, entry)], names=[*keep, "x"])

    chosen = rows.select(*keep, F.col(vector).alias("x"))
    kinds = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in keep)
    return chosen.mapInArrow(quantise, f"{kinds}, x binary")


def usual_dimension(vectors: DataFrame) -> int:
    """The dimension of most of the packed vectors, of several the largest; 0 where there are none."""
    counted = vectors.groupBy((F.length("x") / 8).cast("int").alias("d")).count()
    most = counted.orderBy(F.desc("count"), F.desc("d")).first()
    return most["d"] if most else 0


def of_dimension(vectors: DataFrame, dimension: int) -> DataFrame:
    return vectors.where(F.length("x") == 8 * dimension)
