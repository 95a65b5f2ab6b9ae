"""What a Python worker keeps from task to task: the memory of one operator at a time.

Workers live on between the stages of a job and of a pipeline. An operator that remembers words or
pieces keeps them here under its name; the first task of another operator gives them back, and with
them the pages that the allocators hold.
"""

import ctypes
import ctypes.util
import gc

import pyarrow as pa

_owner, _kept = None, {}


def release_others(owner):
    """Give back what other operators keep."""
    global _owner
    if _owner != owner:
        _kept.clear()
        _owner = owner
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
        if trim:  # freed pages go back to the system
            trim(0)


def remembered(owner, key, make):
    """The value kept by ``owner`` under ``key``, made on first use."""
    release_others(owner)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]
