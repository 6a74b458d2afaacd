"""Exact quantile of a column in a fixed number of passes, without gathering the values."""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 8192
WORD = 64
NOT_FINITE = -1


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = BINS) -> float | None:
    """Linear-interpolated quantile of the non-NULL values, None when there are none.

    NaN and infinite values are refused. The values are selected by radix: finite doubles sort like
    their 64 bits once the sign is folded in, so each pass counts the next bits (at most ``bins``
    groups, counted per batch before the shuffle) of those values that share the bits found so far.
    With 8,192 bins that is five passes, and a sixth one for the value after it, whatever the
    values. Every pass reads ``df``, so hand in a stored or checkpointed table.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must lie between 0 and 1")
    # Adding zero turns -0.0 into 0.0, which it equals.
    values = df.select((F.col(column).cast("double") + F.lit(0.0)).alias("x")).filter("x IS NOT NULL")
    step = min(max(bins.bit_length() - 1, 1), 16)
    found, left, rank, share = 0, WORD, 0, 0.0
    while left:
        width = min(step, left)
        counts = digit_counts(values, found, left, width)
        if counts.pop(NOT_FINITE, 0):
            raise ValueError(f"{column} holds NaN or infinite values")
        if left == WORD:
            n = sum(counts.values())
            if n == 0:
                return None
            rank = math.floor(q * (n - 1))
            share = q * (n - 1) - rank
        for digit in sorted(counts):
            if rank < counts[digit]:
                break
            rank -= counts[digit]
        found = found << width | digit
        left -= width
    at_rank = _number(found)
    # ``rank`` now counts from the first of the equal values at the wanted place.
    if share == 0.0 or rank + 1 < counts[digit]:
        return at_rank
    following = values.agg(F.min(F.when(F.col("x") > at_rank, F.col("x")))).first()[0]
    return at_rank + share * (following - at_rank)


def digit_counts(values: DataFrame, found: int, left: int, width: int) -> dict[int, int]:
    """Values per next ``width`` bits, among those whose bits above the ``left`` lowest are ``found``."""
    counted = values.mapInArrow(_count_digits(found, left, width), "digit bigint, n bigint")
    return {r["digit"]: r["n"] for r in counted.groupBy("digit").agg(F.sum("n").alias("n")).collect()}


def _count_digits(found: int, left: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for tasks; it travels with them, so executors need no copy of this package."""
    word, not_finite = WORD, NOT_FINITE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        top = np.uint64(1 << (word - 1))
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            finite = np.isfinite(x)
            bits = np.ascontiguousarray(x[finite]).view(np.uint64)
            bits = np.where(bits & top, ~bits, bits | top)
            if left < word:
                bits = bits[bits >> np.uint64(left) == np.uint64(found)]
            digits = bits >> np.uint64(left - width) & np.uint64((1 << width) - 1)
            digit, n = np.unique(digits.astype(np.int64), return_counts=True)
            if not finite.all():
                digit, n = np.append(digit, not_finite), np.append(n, (~finite).sum())
            yield pa.RecordBatch.from_arrays([pa.array(digit, pa.int64()), pa.array(n, pa.int64())], ["digit", "n"])

    return count


def _number(bits: int) -> float:
    """The double whose folded bits are ``bits``."""
    top = 1 << (WORD - 1)
    plain = bits ^ top if bits & top else ~bits & ((1 << WORD) - 1)
    return struct.unpack("<d", struct.pack("<Q", plain))[0]
