"""What a Python worker remembers between rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from sys import getsizeof

import pyarrow as pa

# Bytes of an entry beside its key and value: its share of two tables that are never full.
ENTRY = 80
# Keys of more characters are not remembered: they are hardly met again.
LONGEST = 48


class Memory(dict):
    """Results by key (text), made when they are first asked for; about ``limit`` bytes are held.

    Keys, values and entries are counted.  At half the limit the entries become old, and an old one that
    is asked for again becomes young again; so what is common stays and what is rare goes.
    """

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.size = make, limit, 0
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > LONGEST:
            return value
        size = getsizeof(key) + getsizeof(value) + ENTRY
        if self.size + size > self.limit // 2:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[key] = value
        self.size += size
        return value


def release() -> None:
    """Gives freed memory back to the system at the end of a task, as the worker goes on to other stages."""
    pa.default_memory_pool().release_unused()
    # Of the C library on Linux; elsewhere there is none.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
