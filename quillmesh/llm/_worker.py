"""Memory of the executors' Python workers, which live on between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

#: Rows in a batch that goes to a worker, where an operator runs its pass itself.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, and at its end what it freed goes back to the system instead of staying with an idle worker."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim:
                trim(0)

    return wrapped
