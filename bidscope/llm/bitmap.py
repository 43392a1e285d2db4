"""A set of 64-bit values as a bitmap of fixed size, to thin out rows before a shuffle.

The bitmap has the same size whatever it holds, so it may be sent to every task. It lets through
all members and, the fuller it is, some others: an exact join must follow.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm.words import mix

BITS = 24


def _parts(words: int):
    """The bits of a task's values, as one row for each word that is not empty."""

    def run(batches):
        bits = int(words).bit_length() + 5
        held = np.zeros(words, dtype=np.uint64)
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            bit = mix(values) >> np.uint64(64 - bits)
            np.bitwise_or.at(held, bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63)))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, type=pa.int64()), pa.array(held[some].view(np.int64))], names=["word", "bits"]
        )

    return run


def build(values: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap of the one bigint column of ``values``: 2 ** (bits - 6) words, whatever it holds."""
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    parts = values.mapInArrow(_parts(len(words)), "word long, bits long")
    rows = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def holds(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each bigint may be in the bitmap."""
    bits = int(words.size).bit_length() + 5
    bit = mix(values.view(np.uint64)) >> np.uint64(64 - bits)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def may_hold(words: np.ndarray, value: Column) -> Column:
    """True for every value in the bitmap, for null never, for others hardly ever."""

    @F.arrow_udf("boolean")
    def test(values: pa.Array) -> pa.Array:
        return pa.array(holds(words, values.to_numpy(zero_copy_only=False).astype(np.int64)))

    return F.when(value.isNotNull(), test(F.coalesce(value, F.lit(0)).cast("long"))).otherwise(F.lit(False))
