"""What a Python worker remembers between tasks: caches only, never state that a result depends on."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

_NAME = "_corpus_worker_memo"
KEPT = 2  # things that a worker remembers at a time: a worker outlives the stage that it was made for


def memo(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()`` once per worker process (functions travel by value, so module variables don't last), until ``KEPT``
    others have been asked for since."""
    store = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__.setdefault("held", {})
    if key in store:
        store[key] = store.pop(key)  # the newest is last
    else:
        while len(store) >= KEPT:
            del store[next(iter(store))]
        store[key] = make()
    return store[key]
