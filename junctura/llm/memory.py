"""Memory that a task's Python worker no longer needs goes back to the system, since idle workers live on beside the JVM."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Release what Arrow and the C library hold but do not use."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return
