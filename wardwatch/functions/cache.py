"""Reuse of built Column expressions within one SparkContext.

A Column is an unresolved expression tree held by the JVM, valid for any
DataFrame of the same context. Building a wide projection from Python costs
one gateway round trip per operator (thousands for the readings fixture),
so the fixed projections are built once per context and reused.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext

_CACHE: dict = {}


def per_context(fn: Callable) -> Callable:
    """Memoize ``fn(*hashable_args)`` per active SparkContext."""
    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (fn.__module__, fn.__qualname__, id(sc), sc.applicationId if sc else None, args)
        if key not in _CACHE:
            _CACHE[key] = fn(*args)
        return _CACHE[key]
    return wrapper
