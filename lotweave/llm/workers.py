"""Tables that Python workers keep between tasks. A worker holds the tables of one operator at a time."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from typing import Any

#: Name and table of the operator that ran last in this worker.
_HELD: dict[Any, Any] = {}


def kept(name: Any, make: Callable[[], Any]) -> Any:
    """The table called ``name``, made if the worker doesn't hold it; the tables of other operators are dropped first.

    Workers are used again for later tasks and stages, so what a stage leaves in them would otherwise add up.
    """
    if name not in _HELD:
        drop()
        _HELD[name] = make()
    return _HELD[name]


def drop() -> None:
    """Forget all tables and give their memory back to the system, as far as the allocator can."""
    if _HELD:
        _HELD.clear()
        trim()


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` (batches to batches), after which the task's memory goes back to the system and isn't kept for a worker's next task."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return whole


def trim() -> None:
    gc.collect()
    try:
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
    except (ImportError, AttributeError, OSError):
        pass  # an allocator without such a call keeps the memory for the next table
