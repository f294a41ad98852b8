"""A set of 64-bit hashes as bits of fixed number: no hash is missed, some others pass."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24  # 2 MB, whatever the number of hashes; a fuller set only lets more others pass


def bitset_of(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The set of a column's hashes; the driver gets its 2^(bits - 6) words at most."""
    place = F.shiftrightunsigned(column, 64 - bits)
    words = (
        hashes.where(F.col(column).isNotNull())
        .groupBy(F.shiftright(place, 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return table


def in_bitset(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the set."""
    bits = int(len(table)).bit_length() - 1 + 6
    place = hashes.astype(np.uint64) >> np.uint64(64 - bits)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def membership(hashes: DataFrame, column: str, bits: int = BITS) -> Callable[[Column], Column]:
    """A column function: whether a 64-bit hash may be among ``hashes``."""
    shared = hashes.sparkSession.sparkContext.broadcast(bitset_of(hashes, column, bits))

    @F.arrow_udf("boolean")
    def may_be_in(asked: pa.Array) -> pa.Array:
        return pa.array(in_bitset(shared.value, asked.to_numpy(zero_copy_only=False).view(np.uint64)))

    return may_be_in
