"""What a worker process keeps between tasks."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")
_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    """The object this worker keeps under ``key``, made at first use.

    Workers are reused by later stages, so only one object is kept: another key drops what an
    earlier operator has left, and Arrow's free memory goes back to the system.
    """
    if key not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[key] = make()
    return _HELD[key]
