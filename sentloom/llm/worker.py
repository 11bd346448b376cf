"""What a Python worker keeps between tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

#: Seconds of a task between two calls of :func:`release`.
PAUSE = 0.5


def release() -> None:
    """Give back what the allocators hold free; they keep the most that any task of the worker has had otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function for ``mapInArrow``, with :func:`release` now and then between its batches and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def released() -> Iterator[pa.RecordBatch]:
            last = time.monotonic()
            for batch in batches:
                yield batch
                if time.monotonic() - last > PAUSE:
                    release()
                    last = time.monotonic()

        yield from task(released())
        release()

    return run


def kept(owner: str) -> types.ModuleType:
    """A name space of the operator that is at work; what another one has kept is let go.

    Functions travel to the workers by value, so the name space is a module of its own.
    """
    state = sys.modules.setdefault("sentloom_kept", types.ModuleType("sentloom_kept"))
    if state.__dict__.get("owner") != owner:
        state.__dict__.clear()
        state.owner = owner
        gc.collect()
        release()
    return state


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hand texts and sets to Python in batches of few rows while the block runs its steps."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
