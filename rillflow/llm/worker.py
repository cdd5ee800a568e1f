"""Objects that a Python worker keeps from task to task."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

# The package travels with its functions, so a module of its own would be new in every task.
HOLDER = "_rillflow_worker_objects"


def kept(key: tuple, make: Callable[[], Any], large: bool = False) -> Any:
    """The object made for this key in this process, made on first use.

    A large object is held only as long as nothing else is asked for, so that a worker that goes
    on to another operator does not carry it along. Whoever keeps a large object asks for no other
    between its uses.
    """
    holder = sys.modules.setdefault(HOLDER, ModuleType(HOLDER)).__dict__
    small, alone = holder.setdefault("small", {}), holder.setdefault("large", {})
    if alone and key not in alone:
        alone.clear()
        _give_back()
    held = alone if large else small
    if key not in held:
        held[key] = make()
        if large:
            _give_back()
    return held[key]


def _give_back() -> None:
    """Hand freed memory back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass
