"""Arrow batches of any size worked on in pieces of bounded size, and memory given back.

Spark fills a batch by rows, so its size follows from the rows' lengths and, in small tables,
their number. ``bounded`` ends batches at a number of bytes too, and tasks cut them into pieces
before they make arrays of them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Bytes at which Spark ends an Arrow batch; a longer row is a batch of its own.
BATCH_BYTES = 1 << 23
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on ends Arrow batches at ``BATCH_BYTES``, by Spark's own
    setting, which is read when a plan runs. A value that the user set stays."""
    settings = df.sparkSession.conf
    if settings.get(BATCH_SETTING, None) is None:
        settings.set(BATCH_SETTING, str(BATCH_BYTES))
    return df


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges (start, end) that follow each other and hold at most ``most`` in all of
    ``sizes``, or a single row. No rows give no range."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, end
        start = end


def release() -> None:
    """Give free memory of this process back to the system. Spark keeps Python processes for
    later tasks; what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(work: Callable) -> Callable:
    """``work`` on batches, after which its process gives memory back."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release()

    return run
