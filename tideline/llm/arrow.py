"""Arrow batches to numpy: bounded slices of text, and key/value output.

Every Python step of this subpackage is a ``mapInArrow`` over a stream of
batches. A batch is cut into slices of about ``max_bytes`` of text (always
whole rows, at least one), so working memory follows the slice or the longest
single text, never the partition. Spark keeps Python workers for the next
task, so a step gives back what it grew when its batches end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tideline.llm import hashing

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20  # of rows that Spark hands over at once (or one row)


def text_slices(batch: pa.RecordBatch, col: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of runs of rows; null is empty.

    ``offsets`` has one entry more than rows and starts at 0; ``bytes`` is
    the UTF-8 of all rows of the slice, one after the other.
    """
    arr = batch.column(batch.schema.get_field_index(col))
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    n = len(arr)
    if n == 0:
        return
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64, count=n + 1, offset=8 * arr.offset)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, offs[lo:hi + 1] - offs[lo], data[offs[lo]:offs[hi]]
        lo = hi


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def out(names: list[str], *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays],
                                      names=names)


def release() -> None:
    """Give memory that nothing uses back to the system: tables grown on demand, arrow's pool, the C library's."""
    hashing.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` over batches of ``BATCH_BYTES`` (a setting of the session), released at the end."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def body(it):
        yield from run(it)
        release()

    return df.mapInArrow(body, schema)
