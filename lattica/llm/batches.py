"""Arrow batches in parts, so that Python holds few texts at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa


def parts(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many. At their end the task's free memory goes back to the machine: Spark keeps
    Python workers for later tasks, and those that wait would hold what they once needed."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
