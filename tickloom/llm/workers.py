"""What Python workers keep between tasks."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def give_back() -> None:
    """Returns freed memory to the system at a task's end. Workers stay alive for later tasks, also of other stages, and
    allocators would keep the peak of each for good."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass
