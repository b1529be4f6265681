"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

# The key of the object that all operators share; of the others a worker keeps one.
SHARED = "words"


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The worker's object of this key, made on first use.

    UDFs are shipped by value, so their module's globals are new in every task;
    this holder is the worker process's own and is never pickled.
    """
    holder = sys.modules.setdefault("eventlake_kept", types.ModuleType("eventlake_kept"))
    objects = holder.__dict__.setdefault("objects", {})
    if key not in objects:
        if key != SHARED:
            for other in [k for k in objects if k != SHARED]:
                del objects[other]
            give_back()
        objects[key] = make()
    return objects[key]


def give_back() -> None:
    """Hands memory that the worker has freed back to the system, as the worker lives on beside other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
