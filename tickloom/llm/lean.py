"""Python workers that give memory back.

A worker process lives on between tasks, and what its allocators keep of a task's large arrays is lost to the executor until
the worker needs as much again. `lean` wraps a function that Spark runs on Arrow data: when its task or group is
done, free memory goes back to the system. What an operator keeps for its next tasks (`kept`) goes when the worker turns to
a task of another operator.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import cache
from inspect import isgeneratorfunction

import pyarrow as pa
from pyspark.sql import SparkSession

from tickloom.session import ship


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


_KEPT: dict[str, list] = {}


def kept(fn: Callable) -> Callable:
    """`functools.cache` for what a worker keeps from task to task of the operator in whose module `fn` stands."""
    made = cache(fn)
    _KEPT.setdefault(fn.__module__, []).append(made)
    return made


def turn_to(module: str) -> None:
    """A task of that module's operator begins: what others keep goes."""
    others = [made for name, all_ in _KEPT.items() if name != module for made in all_ if made.cache_info().currsize]
    for made in others:
        made.cache_clear()
    if others:
        give_back()


def lean(fn: Callable) -> Callable:
    """For `mapInArrow` (a generator) or `applyInArrow` (Spark counts the parameters, so they are spelled out).

    Called where a plan is built, so it also sees to it that the workers have this package.
    """
    if (spark := SparkSession.getActiveSession()) is not None:
        ship(spark)
    module = fn.__module__
    if isgeneratorfunction(fn):

        def mapped(batches):
            turn_to(module)
            try:
                yield from fn(batches)
            finally:
                give_back()

        return mapped
    if fn.__code__.co_argcount == 2:

        def grouped(key, table):
            turn_to(module)
            try:
                return fn(key, table)
            finally:
                give_back()

        return grouped

    def cogrouped(key, left, right):
        turn_to(module)
        try:
            return fn(key, left, right)
        finally:
            give_back()

    return cogrouped
