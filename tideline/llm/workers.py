"""What a Python worker keeps between tasks.

Spark hands a worker on to the tasks of later steps and queries, with all that was loaded in it. A task of an
operator that needs room of its own drops what others have left there, and hands free memory back to the system.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa

_KEPT: list = []


def kept_in_worker(build: Callable) -> Callable:
    """Like ``lru_cache(maxsize=1)``, until a task that calls ``start_lean`` runs in the same worker."""
    kept = lru_cache(maxsize=1)(build)
    _KEPT.append(kept)
    return kept


def start_lean() -> None:
    """Drop what is kept in this worker; it is built again where it is needed again."""
    for kept in _KEPT:
        kept.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only; elsewhere the allocator decides
    if trim:
        trim(0)
