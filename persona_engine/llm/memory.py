"""Memory of Python workers, which Spark keeps from task to task and from stage to stage."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def release_memory() -> None:
    """Hands what a task has freed back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
